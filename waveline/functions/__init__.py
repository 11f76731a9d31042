"""Column functions: geometry, names, sample arrays."""
