"""Declared checks and the batch run."""
