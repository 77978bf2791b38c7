"""Operators for large training-data pipelines: the ten dealt operators, their queries and SQL.

Nothing outside this package imports it; ``corpus_pipeline.py`` and the
guarded import in ``__spark_entry__.py`` are its only users.
"""
