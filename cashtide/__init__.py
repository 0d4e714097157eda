"""Cashtide: ticker-level sentiment signals from short public posts, as Spark jobs."""

__version__ = "0.1.0"
