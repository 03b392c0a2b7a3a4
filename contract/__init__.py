"""Registered queries: inputs derived from the given tables, plans, and oracle SQL."""
