"""Operators of a training-data pipeline over a table of documents.

Every operator takes a DataFrame with at least ``doc_id`` and ``text`` (other columns are
ignored unless its docstring names them) and returns a DataFrame.  A null text counts as
the empty text.  Repeated rows are separate documents that happen to share an id.
"""
