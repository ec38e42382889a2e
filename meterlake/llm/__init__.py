"""Operators for large-scale training data, one module each; see queries.py for the registered forms."""
