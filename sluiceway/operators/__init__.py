"""DataFrame to DataFrame operators. Each works on batch and streaming DataFrames alike."""
