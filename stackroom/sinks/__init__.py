"""Digests, captions and dataset exports."""
