"""Operators for preparing training corpora, and the queries that apply them to the test tables."""
