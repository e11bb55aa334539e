"""Gleaner: a PySpark-native engine for listing extraction and consolidation."""
