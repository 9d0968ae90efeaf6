"""Composite plans: the batch pipeline, the query catalog and its SQL oracle."""
