"""Spark-native analytics for comparative annotation tables."""
