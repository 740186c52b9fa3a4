"""Ingest, clean and load messy tables with Spark."""
