"""Corpus operators for training-data pipelines.

Nothing else in the library imports this subpackage; it may be removed as a
whole.  ``queries.QUERIES`` and ``queries.SQL`` hold the registered queries."""
