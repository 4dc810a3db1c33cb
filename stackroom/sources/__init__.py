"""Readers that keep source order."""
