"""Spark jobs that clean, score, select and sample large text corpora."""

__version__ = "0.1.0"
