"""Shared expressions and driver-side closed-form distribution tails."""
