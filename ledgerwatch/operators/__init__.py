"""Batch operators, all ``DataFrame -> DataFrame``."""
