"""Operators for training-data pipelines: documents in, decisions about documents out."""
