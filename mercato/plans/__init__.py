"""Assembled plans: the query registry and the batch run."""
