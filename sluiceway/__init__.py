"""Message ingestion on Spark: read, decode, route and append, in batch and in streams."""
