"""Operators for preparing text for language models."""
