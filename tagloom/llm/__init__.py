"""Operators for preparing a training corpus.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries.py`` registers one query per operator.
"""
