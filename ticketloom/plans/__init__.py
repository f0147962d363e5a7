"""Whole jobs: sources, operators and sinks wired together."""
