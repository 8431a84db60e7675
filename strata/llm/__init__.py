"""Operators for large-scale training-data preparation.

Thirteen operators over documents, pages, embeddings and conversations (one
module each) and their registered queries (``queries.py``). Nothing else in the library
imports this subpackage.
"""
