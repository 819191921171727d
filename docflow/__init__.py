"""Incremental document-collection analytics as PySpark DataFrame operators."""
