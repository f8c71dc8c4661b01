"""Whole jobs: publications, taxonomy, registry, network, baselines, searches, reports."""
