"""Column-level building blocks: addresses, wide integers, times."""
