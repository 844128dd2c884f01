"""Scans: JSON, delimited text, databases, file listings, rule documents, routing."""
