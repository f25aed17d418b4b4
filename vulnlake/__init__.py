"""Spark-native analytics over nested vulnerability-feed records."""
