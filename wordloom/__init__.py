"""Spark-native measurement, rating, selection and integrity of text items."""
