"""Spark-native engine that turns page documents into a typed knowledge graph and measures it."""

__version__ = "0.1.0"
