"""Whole products, from native fields to checked tables."""
