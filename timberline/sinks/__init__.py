"""Writers: partitioned Parquet, CSV exports, the run log."""
