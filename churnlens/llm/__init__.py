"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``pages``.

Nothing outside this package imports it; ``corpus_pipeline.py`` at the repository root chains five
of the operators.
"""
