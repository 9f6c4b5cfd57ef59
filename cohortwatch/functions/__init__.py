"""Functions that build columns."""
