"""Fraud analytics on Spark: ingest, features, statistics, drift, models, streams."""
