"""Reusable DataFrame operators: time matching, lookups, shaping."""
