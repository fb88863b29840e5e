"""Operators for preparing language-model training data.

Nothing else in the library imports this package; its queries and SQL live in
:mod:`kinetrace.llm.queries`.
"""
