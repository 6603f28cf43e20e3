"""The four analyses end to end, composed from the operators."""
