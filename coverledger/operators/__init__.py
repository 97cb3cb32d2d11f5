"""DataFrame operators shared by the curated and mart models."""
