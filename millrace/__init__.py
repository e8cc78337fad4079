"""Spark operators for a layered real-time warehouse."""
