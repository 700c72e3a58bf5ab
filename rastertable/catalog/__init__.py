"""Every operator as a named query on the driver tables, with its SQL."""

from __future__ import annotations

from rastertable.catalog.registry import ORACLES, QUERIES, Query


def _load() -> None:
    from rastertable.catalog import cells, sampling, scenes, spatial  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
