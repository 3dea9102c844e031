"""Training-data operators: sharding, filtering, near-duplicate search,
extraction, archives, tokenisation and chat formatting.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` holds the registered
``opN_*`` queries that apply them to whole tables.
"""
