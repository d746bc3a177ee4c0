"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from fathomline.catalog.registry import REGISTRY, Query, Tables

MODULES = ("loads", "rules", "joins", "aggs", "ordering", "scalars", "care", "attendance", "organisation", "audit", "records", "claims")


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"fathomline.catalog.{name}")
    return dict(REGISTRY)


__all__ = ["Query", "Tables", "all_queries"]
