"""Spatial accessibility analytics as PySpark DataFrame jobs."""
