"""Queries over tables, with their SQL, and the packaging pipeline."""
