"""Readers and writers of tabular and record-structured text."""
