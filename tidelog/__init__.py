"""Tidelog: a PySpark-native engine for ingesting, storing and querying telemetry logs."""
