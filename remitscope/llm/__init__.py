"""Operators for training-data corpora: text documents, web pages and embedding vectors."""
