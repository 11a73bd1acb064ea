"""Writers: keyed JSON messages, batch status, partitioned and idempotent Parquet, preview."""
