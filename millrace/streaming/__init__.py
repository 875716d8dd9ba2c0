"""Streaming: watermarks, stateful operators, and running queries."""
