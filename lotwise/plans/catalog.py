"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from lotwise.plans.bindings import ORACLES, QUERIES, Query

SECTIONS = ("scans", "cleaning", "profiles", "drifts", "decisions", "scoring", "learning", "streams")


def _load() -> None:
    for section in SECTIONS:
        import_module(f"lotwise.plans.{section}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
