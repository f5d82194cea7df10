"""Operators for large-scale training-data pipelines.

Nothing outside this folder imports it; ``lexloom.llm.registry`` lists its
queries and ``corpus_pipeline.py`` chains five of its operators.
"""
