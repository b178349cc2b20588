"""Incremental runs of the batch plans."""
