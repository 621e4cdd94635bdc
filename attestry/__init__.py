"""Attestry: a PySpark-native engine for provenance-preserving evidence tables."""

__version__ = "0.1.0"
