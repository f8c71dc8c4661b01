"""Readers, writers, declared schemas and fixed code tables."""
