"""Operators for large-scale training data.  Nothing outside imports this."""
