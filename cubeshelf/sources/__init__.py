"""Readers and writers of the warehouse's files."""
