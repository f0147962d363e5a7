"""Readers: warehouse tables, landed JSON responses and CSV."""
