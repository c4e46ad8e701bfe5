"""Catalog tables: creating, writing, listing, repairing, dropping."""
