"""Tamarack: a PySpark-native engine for curating, auditing and scoring text corpora."""

__version__ = "0.1.0"
