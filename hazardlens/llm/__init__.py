"""Operators for building training corpora from documents and web pages."""
