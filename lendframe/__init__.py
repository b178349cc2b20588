"""Loan-level mortgage disclosure analytics as Spark DataFrame jobs.

Layers: ``sources`` reads and lists files, ``functions`` holds column
expressions, ``operators`` holds DataFrame-to-DataFrame transforms, ``plans``
composes them into jobs, ``streaming`` runs the silver plan incrementally.
"""

__version__ = "0.1.0"
