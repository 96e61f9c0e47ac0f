"""Readers and writers: lake tables, operational tables, event feed, settlement files."""
