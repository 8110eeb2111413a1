"""Registered queries: each is a Spark callable (spark, sf_dir) -> DataFrame,
optionally paired with an equivalent DuckDB SQL text used as oracle."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for m in ("ledgerlake.plans.commercial", "ledgerlake.plans.etl", "ledgerlake.plans.budget",
              "ledgerlake.plans.finance", "ledgerlake.plans.plant", "ledgerlake.plans.treasury",
              "ledgerlake.plans.risk", "ledgerlake.plans.series",
              "ledgerlake.plans.econometrics", "ledgerlake.plans.star", "ledgerlake.plans.texts", "ledgerlake.plans.quality", "ledgerlake.plans.causal",
              "ledgerlake.plans.conform"):
        importlib.import_module(m)
