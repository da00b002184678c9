"""Column functions: plain Python functions that return a ``Column``."""
