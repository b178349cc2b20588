"""Registered queries: fixture views, Spark queries and their SQL counterparts."""
