"""Operators for large training-data pipelines; nothing else in waveline imports them."""
