"""Operators of a training-data pipeline: quality, token files, search, personal data, byte-level
BPE, packing, passage dedup, language-model scores, similarity joins and embedding dedup.

Nothing else in the library imports this package.  The registered queries are in ``queries``.
"""
