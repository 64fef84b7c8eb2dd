"""Named queries over the given tables, one per operator or report."""

from __future__ import annotations

import importlib

from rosterline.plans.registry import BUILDS, SQL, Build

MODULES = ("access", "controls", "devices", "histories", "ingest", "lifecycles")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"rosterline.plans.{name}")


def all_queries() -> dict[str, Build]:
    _load()
    return dict(BUILDS)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
