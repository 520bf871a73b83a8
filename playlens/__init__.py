"""Spark-native product analytics for mobile-game event streams."""
