"""Readers and writers: routes, messages, tables."""
