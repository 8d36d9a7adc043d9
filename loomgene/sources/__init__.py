"""Readers and writers of sequence, feature and submission files."""
