"""Operators of a training-data pipeline over documents and embeddings.

Nothing else in the package imports this one.  ``queries.py`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
