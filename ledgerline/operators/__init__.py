"""Relational building blocks composed from DataFrame operations."""

from ledgerline.operators import relational, aggregates, quality  # noqa: F401
