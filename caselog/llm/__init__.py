"""Operators for building training corpora, one module each, with their registered queries."""
