"""Column builders and Python functions that run in tasks."""
