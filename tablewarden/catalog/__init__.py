"""The registered queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable


def all_queries() -> dict[str, Callable]:
    return _merged("QUERIES")


def all_sql() -> dict[str, str]:
    return _merged("ORACLE")


def _merged(attribute: str) -> dict:
    from tablewarden.catalog import cleaning, files, integrity, profile, reports, splits

    out: dict = {}
    for module in (profile, cleaning, integrity, splits, reports, files):
        part = getattr(module, attribute)
        if twice := out.keys() & part.keys():
            raise ValueError(f"queries registered twice: {sorted(twice)}")
        out |= part
    return out
