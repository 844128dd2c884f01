"""Whole loads: one declaration in, files and an audit trail out."""
