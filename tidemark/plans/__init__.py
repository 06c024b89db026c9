"""Layer and lifecycle tables composed from the operators."""
