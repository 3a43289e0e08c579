"""Readers, writers, versioned tables and feed shaping."""
