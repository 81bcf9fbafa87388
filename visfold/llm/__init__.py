"""Operators for large-scale training-data pipelines (documents, pages, embeddings).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
