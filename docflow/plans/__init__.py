"""End-to-end runs, and the registered queries over the provided tables."""
