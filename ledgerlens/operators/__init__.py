"""Reusable DataFrame recipes used by several plans."""
