"""Spark-native ingest, search and publishing engine for crawled documents."""
