"""Schemas, sources, sinks and catalog tables."""
