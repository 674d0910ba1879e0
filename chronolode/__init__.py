"""Chronolode: a Spark-native engine for archives of named time-series signals."""
