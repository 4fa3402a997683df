"""Composed plans: the curation pipeline and the query catalogue."""
