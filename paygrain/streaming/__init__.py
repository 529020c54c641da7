"""Consuming new bronze loads as a stream."""
