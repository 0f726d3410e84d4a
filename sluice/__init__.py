"""Sluice: a Spark-native sales lakehouse and analytics engine."""
