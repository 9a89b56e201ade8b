"""Reading and writing: delimited text, Parquet, JDBC."""
