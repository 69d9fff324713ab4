"""Operators over pixel, zone and point tables."""
