"""Spark-native engine for time-stamped channel pulses: triggering, reduction, reconstruction."""
