"""skeindex: document retrieval on Spark DataFrames (clean, chunk, index, search)."""
