"""Readers: fixed-schema and headered CSV, JSON manifests, file listings, stored tables."""
