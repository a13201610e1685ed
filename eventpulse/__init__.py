"""Spark-native analytics for streams of activity events."""
