"""Spark-first analytics for range-image scenes, labels and training data."""
