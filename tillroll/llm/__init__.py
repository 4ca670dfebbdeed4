"""Operators of a training-data pipeline over documents, pages and vectors.

Each module holds one operator with its own DataFrame interface; ``entry.py`` holds the
thin registered queries.  Nothing outside this package imports it.
"""
