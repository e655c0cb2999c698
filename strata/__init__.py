"""Layered analytical tables on Spark: ingest, clean, version and load dimensions and facts."""
