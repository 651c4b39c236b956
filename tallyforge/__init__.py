"""Spark-native tool-call data preparation and evaluation engine."""
