"""Spark-native narrative graph analytics."""
