"""Spark-native analytics for gridded environmental time series."""
