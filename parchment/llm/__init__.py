"""Operators for preparing training text at scale (one module each)."""
