"""Incremental processing of newly landed quarters."""
