"""Operators for preparing training data at scale; see ``queries.QUERIES``."""
