"""The tables users query, composed from the operators."""
