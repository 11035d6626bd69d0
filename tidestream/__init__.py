"""Clickstream analytics on Spark: ingest, metrics, streaming and propensity models."""
