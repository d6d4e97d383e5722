"""Operators of a training-data pipeline: one module per operator, and the queries that apply them.

Nothing outside this folder imports it but ``corpus_pipeline.py`` and the guarded import of the entry point.
"""
