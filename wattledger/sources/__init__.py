"""Readers, payload decoding and writers."""
