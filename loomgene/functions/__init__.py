"""Column functions: attributes, sequences, intervals, names."""
