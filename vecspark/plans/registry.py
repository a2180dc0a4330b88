"""Registry of named queries: Spark builder ``(spark, sf_dir) -> DataFrame`` plus optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that it registers itself."""
    from . import q_text, q_tensor, q_embed, q_metrics, q_layers, q_train  # noqa: F401
