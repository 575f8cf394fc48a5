"""Reading and writing: CSV, JDBC, Parquet tables, published runs, test tables."""
