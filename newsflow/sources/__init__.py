"""Corpus, message and table sources."""
