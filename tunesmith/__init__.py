"""Spark-native preparation and evaluation of fine-tuning data."""
