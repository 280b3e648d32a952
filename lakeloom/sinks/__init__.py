"""Writers: delimited text, Parquet, JSON, published tables and views."""
