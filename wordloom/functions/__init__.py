"""Column builders: text measurement, classification and hashing."""
