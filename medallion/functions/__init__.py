"""Column expressions: cleaning, text handling and embeddings."""
