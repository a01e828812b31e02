"""Operators for large-scale training-data pipelines, each a Spark job of its own.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
