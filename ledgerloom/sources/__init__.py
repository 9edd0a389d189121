"""Readers for the tables and the landed input files."""
