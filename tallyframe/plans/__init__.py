"""Reports built from the operators, and their bindings to concrete tables."""
