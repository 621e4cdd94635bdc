"""Readers and publication."""
