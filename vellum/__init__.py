"""Spark-native text canonicalisation engine."""
