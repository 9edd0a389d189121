"""Table-level building blocks: each takes DataFrames and returns DataFrames."""
