"""Incremental runs of the stateless operators."""
