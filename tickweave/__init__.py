"""Spark-native analytics over framed binary market-data captures."""
