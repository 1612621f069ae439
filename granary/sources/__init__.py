"""Readers. Known data is read with an explicit schema, so no scan is spent on inference."""
