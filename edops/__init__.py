"""Spark-native analytics for emergency-department visits and event streams."""
