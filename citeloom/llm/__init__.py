"""Operators over training documents: filtering, deduplication, decontamination, packing, token files."""
