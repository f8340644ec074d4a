"""Composed plans: the study pipeline, the query catalog and its SQL oracle."""
