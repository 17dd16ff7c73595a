"""Reading and writing: CSV, keyed JSON messages, JDBC, Parquet tables."""
