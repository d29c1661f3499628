"""Writers: Parquet, text, graph JSON, SQL text."""
