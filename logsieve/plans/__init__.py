"""Query compositions over the operators."""
