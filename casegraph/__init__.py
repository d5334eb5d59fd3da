"""Spark-native engine that turns overlapping records into canonical cases."""
