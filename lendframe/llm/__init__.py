"""Operators for training-data corpora; nothing else in the package imports this one."""
