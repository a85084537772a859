"""Registered queries and their SQL checks."""

from __future__ import annotations

from liftlab.queries.registry import ORACLES, QUERIES, Query


def _load() -> None:
    from liftlab.queries import evolution, medallion, movement, offers  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
