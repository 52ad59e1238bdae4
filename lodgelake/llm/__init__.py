"""Operators of a large-scale training-data pipeline.

Every operator takes DataFrames and returns DataFrames; nothing else in the library imports
this subpackage.  ``queries.py`` holds the thin registered queries, ``corpus_pipeline.py`` at
the top of the repository chains five of the operators.
"""
