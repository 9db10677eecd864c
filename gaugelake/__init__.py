"""Spark-native lakehouse for hourly gauge (sensor station) observations."""
