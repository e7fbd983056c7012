"""DataFrame operators of the consolidation pipeline."""
