"""Spark-native engine for energy-market curves: catalog, request planning, curation, keyed tables, event streams."""
