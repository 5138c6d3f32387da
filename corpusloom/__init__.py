"""Corpusloom: DataFrame-to-DataFrame analytics over addressable text corpora on Spark."""

__version__ = "0.1"
