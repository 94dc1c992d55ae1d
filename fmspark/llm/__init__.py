"""Operators of a training-data pipeline: deduplication, filtering, mixing,
search, scans and packing over the ``documents`` and ``embeddings`` tables.
Nothing outside this subpackage imports it."""
