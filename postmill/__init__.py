"""Spark-native ingest, merge, audit and profiling of microblog posts."""

__version__ = "0.1.0"
