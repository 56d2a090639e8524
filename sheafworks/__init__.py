"""Spark-native engine for building and querying document corpora."""
