"""Readers: files, catalog tables, named sources, schema discovery."""
