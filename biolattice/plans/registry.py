"""Registry of the named queries."""
from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MODULES = ("q_sources", "q_clean", "q_joins", "q_community", "q_acoustic", "q_trends", "q_models",
           "q_genetics", "q_grids", "q_live")


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}


def half_away(x: Column, digits: int) -> Column:
    s = 10.0 ** digits
    big = F.isnan(x) | (F.abs(x) * s > 4e15)
    return F.when(big, x).otherwise(F.signum(x) * F.floor(F.abs(x) * s + 0.5) / s + F.lit(0.0))


def shaped(df: DataFrame, digits: dict[str, int], whole: list[str]) -> DataFrame:
    """Doubles rounded for comparison (half away from zero, in plain double arithmetic), counts as
    bigint."""
    out = {c: half_away(F.col(c).cast("double"), d) for c, d in digits.items()}
    out |= {c: F.col(c).cast("bigint") for c in whole}
    return df.withColumns(out) if out else df


def query(name: str, ids: str, sql: str | None = None, r: str = "", i: str = "", d: int = 6):
    """Register a query. r: columns to round, to d digits or to those of `name:digits`; i: counts."""
    digits = {}
    for c in r.split():
        n, _, k = c.partition(":")
        digits[n] = int(k) if k else d
    whole = i.split()

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return shaped(fn(spark, sf_dir), digits, whole)

        text = None
        if sql is not None:
            rep = [f"round(CAST({c} AS DOUBLE), {k}) + 0.0 AS {c}" for c, k in digits.items()]
            rep += [f"CAST({c} AS BIGINT) AS {c}" for c in whole]
            text = f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql.strip()}\n)" if rep else sql.strip()
        if name in REGISTRY:
            raise KeyError(name)
        REGISTRY[name] = Query(run, text, ids)
        return fn

    return deco


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: q.run for k, q in REGISTRY.items()}


def all_sql() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
