"""Listing analytics on Spark: ingest, identity, state, enrichment and search as DataFrame operators."""
