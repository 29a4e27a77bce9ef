"""Spark-native engine for building clean monolingual text corpora."""
