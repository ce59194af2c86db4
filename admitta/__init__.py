"""Spark-native extraction, matching and fusion of admission records."""
