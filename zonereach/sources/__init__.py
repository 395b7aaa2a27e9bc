"""Schemas, readers, writers and derived input tables."""
