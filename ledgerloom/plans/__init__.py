"""The stages of a run: each reads tables, composes operators and writes tables."""
