"""Continuous forms of the checks, as Structured Streaming queries."""
