"""Registry of checked queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c: Column | str, name: str, digits: int = 6) -> Column:
    """Rounded for comparison: sums of doubles depend on their order in the last digits.

    Half away from zero like ``round``, which goes through decimals and is much slower.
    """
    x = (F.col(c) if isinstance(c, str) else c).cast("double") * F.lit(10.0 ** digits)
    whole = F.when(x >= 0, F.floor(x + 0.5)).otherwise(F.ceil(x - 0.5))
    return (whole.cast("double") / F.lit(10.0 ** digits)).alias(name)
