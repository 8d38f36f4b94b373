"""Registered queries and the SQL each of them is compared with."""

from __future__ import annotations

import importlib

MODULES = ("products", "cleaning", "relational", "assurance")


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"checks.{module}")


def all_queries() -> dict:
    from checks.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from checks.registry import ORACLES

    _load()
    return dict(ORACLES)
