"""Curated models, and the ingest and build runs made of them."""
