"""Registered queries over the benchmark tables, each with its SQL twin."""

from importlib import import_module

from geopanel.catalog.registry import ORACLES, QUERIES

for _module in ("bands", "figures", "keys", "records", "series", "text", "sources",
                "geometry", "published"):
    import_module(f"geopanel.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
