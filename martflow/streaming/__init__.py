"""Structured Streaming ingest: file drops -> enrich -> stage -> load."""
