"""Operators for preparing training data (one module each) and the queries that run them.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
