"""Operators for preparing language-model training data.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
