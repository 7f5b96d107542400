"""Readers, writers and reference dimensions."""
