"""Readers that all end in one of the schemas of ``cashtide.schemas``."""
