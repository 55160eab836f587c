"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  :mod:`tessera.llm.queries`
registers one query per operator; ``corpus_pipeline.py`` chains five of them.
"""
