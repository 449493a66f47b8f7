"""Spark-native geospatial feature engine."""
