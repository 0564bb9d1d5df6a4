"""Operators for preparing training data (text corpora) at scale.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; :mod:`sparkmart.llm.queries` registers
the thin queries that apply them to the given tables.
"""
