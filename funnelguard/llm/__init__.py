"""Operators of a training-data pipeline over a table of documents.

One module per operator; ``queries.py`` holds the registered queries and
their SQL. Nothing outside this package (and ``corpus_pipeline.py``) imports
it.
"""
