"""Ingest that goes on where it stopped."""
