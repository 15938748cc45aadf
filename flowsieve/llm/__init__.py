"""Operators for large text and embedding corpora, each by the method its module names."""
