"""Column expressions: dates, file names, labels, coordinates, positions."""
