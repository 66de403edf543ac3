"""Readers of documents and tables, and writers of results."""
