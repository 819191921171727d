"""Readers and writers of the tables in `docflow.schemas`."""
