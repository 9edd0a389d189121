"""Writers: sorted Parquet tables and run metadata."""
