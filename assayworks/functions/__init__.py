"""Column builders: text, lookup, time and JSON expressions."""
