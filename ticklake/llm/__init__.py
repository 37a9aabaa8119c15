"""Operators for large-scale training-data preparation.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
