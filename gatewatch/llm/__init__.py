"""Operators for large training-text corpora.

They work on a table of documents with at least ``doc_id`` and ``text``. Nothing else in
the library imports this package.
"""
