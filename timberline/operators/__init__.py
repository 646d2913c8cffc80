"""Reusable DataFrame operators that the plans are composed of."""
