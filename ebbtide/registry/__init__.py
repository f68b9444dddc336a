"""Registered queries, each with the SQL that states the same result independently."""

from ebbtide.registry.base import ORACLES, QUERIES


def load_all() -> None:
    from ebbtide.registry import (  # noqa: F401
        analysis, cleaning, decisions, drift, ingest, modelling, ordering, quality, streams, warehouse,
    )


__all__ = ["ORACLES", "QUERIES", "load_all"]
