"""Operators for preparing text corpora at scale. Nothing outside this
subpackage, its tests and ``corpus_pipeline.py`` imports it."""
