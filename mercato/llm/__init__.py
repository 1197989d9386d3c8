"""Operators for training-data pipelines (text, tokens, embeddings, conversations).

Nothing else in the package imports this subpackage.
"""
