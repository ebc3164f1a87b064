"""Training-data operators (sharding, tokenising, quality, dedup, packing, ...).

Nothing outside this package imports it; ``__spark_entry__.py`` adds
``llm.queries.QUERIES`` only when the package can be imported.
"""
