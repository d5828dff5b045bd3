"""Catalog, polygon, cell and file-manifest readers and writers."""
