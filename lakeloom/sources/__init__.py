"""Readers, writers, JSON messages and versioned tables."""
