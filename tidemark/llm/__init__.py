"""Operators for building language-model training data, and their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
