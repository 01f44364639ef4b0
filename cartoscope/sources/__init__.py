"""Readers and writers of the domain's files."""
