"""Table-level plans built from the operators."""
