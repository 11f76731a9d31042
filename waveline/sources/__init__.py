"""Readers and writers: packed archives, tables, products."""
