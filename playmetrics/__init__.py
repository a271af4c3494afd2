"""Spark-native product analytics for game telemetry."""
