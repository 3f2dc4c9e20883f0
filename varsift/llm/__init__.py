"""Training-data operators (quality, deduplication, filters, tokenizing) as Spark jobs.

Nothing else in the library imports this subpackage; ``llm/queries.py`` holds the registered queries.
"""
