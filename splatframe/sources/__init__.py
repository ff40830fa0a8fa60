"""Readers and writers of splat containers."""
