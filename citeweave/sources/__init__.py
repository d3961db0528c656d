"""Readers and writers: term lists, corpus tables, landed look-ups and pages."""
