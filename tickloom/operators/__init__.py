"""Transforms from DataFrame to DataFrame, free of source and sink."""
