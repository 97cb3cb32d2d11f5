"""Curated and mart models, and the warehouse that ties them together."""
