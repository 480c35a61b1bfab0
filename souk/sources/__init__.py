"""Reading and writing: raw CSV tables, Parquet layers, JSON documents, and the star-schema adapter."""
