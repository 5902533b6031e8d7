"""Operators for preparing training text: scoring, formatting, matching, packing."""
