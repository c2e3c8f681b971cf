"""Spark-native operators that turn screen-recording corpora into text training data."""
