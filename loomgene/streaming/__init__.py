"""Streaming forms of stateless and windowed operators."""
