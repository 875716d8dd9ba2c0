"""Sinks: topics, stores, dimension tables."""
