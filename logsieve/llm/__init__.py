"""Operators for large-scale training-data work (one module per operator)."""
