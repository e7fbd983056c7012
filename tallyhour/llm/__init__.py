"""Training-data operators: tokens, scoring, classification, search, formatting and deduplication.

Nothing else in the package imports this subpackage. Each module holds one
operator with its own general interface; ``entry_queries`` holds the thin
registered queries.
"""
