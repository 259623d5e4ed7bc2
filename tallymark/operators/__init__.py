"""Reusable DataFrame operators; every named analysis is a thin binding of these."""
