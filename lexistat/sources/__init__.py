"""Readers, writers and the tables derived from landed data."""
