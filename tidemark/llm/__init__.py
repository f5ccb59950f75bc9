"""Operators of a training-data pipeline over documents and embeddings. Nothing outside imports this package."""
