"""Column functions: names, instants, attributes, values."""
