"""Operators that prepare text corpora for language-model training.

Nothing else in the package imports this subpackage. Every operator takes and
returns DataFrames; :mod:`gridmill.llm.registry` holds the registered queries.
"""
