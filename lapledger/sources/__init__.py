"""Readers and writers. Schemas are explicit; nothing is inferred."""
