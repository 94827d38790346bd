"""Readers, writers and quote sources."""
