"""Pixloom: Spark-native operators for building, de-duplicating and evaluating image-text corpora."""

__version__ = "0.1.0"
