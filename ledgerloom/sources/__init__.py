"""Readers, the file registry, rate state and writers."""
