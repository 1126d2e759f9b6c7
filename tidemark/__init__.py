"""Tidemark: a PySpark-native analytics engine for market time series and the reference data around them."""
