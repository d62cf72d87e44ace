"""Training-data operators: dedup, near-duplicate join, tokens, packing, shards, language, secrets, quality.

Nothing else in the package imports this subpackage; its queries are in ``llm.queries``.
"""
