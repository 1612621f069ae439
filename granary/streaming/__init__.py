"""Incremental file landing."""
