"""Spark-native point-in-time feature store and two-stage ranking analytics."""
