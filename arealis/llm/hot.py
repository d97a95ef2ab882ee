"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot if it holds more than this part of all rows, so there are fewer hot keys than this.
HOT_PARTS = 1024


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_counted(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Inner join, null-safe, of ``rows`` with ``table``, which has one row per key.

    ``table[n]`` is the number of rows of the key. Keys with more than 1/1024 of all
    rows, thus fewer than 1024 keys, are sent to the rows instead of gathering their
    rows in one task; every other key is small enough for the shuffled join. ``rows``
    is read twice, so it should be a written table. The column ``n`` is left out.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    limit = max(total // HOT_PARTS, 1)
    values = [c for c in table.columns if c not in keys and c != n]
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    aliases = [f"_k_{k}" for k in keys]

    def on(frame: DataFrame, other: DataFrame) -> Column:
        return reduce(lambda a, b: a & b,
                      [frame[k].eqNullSafe(other[f"_k_{k}"]) for k in keys])

    hot = table.filter(F.col(n) > limit).select(*named, *values, F.lit(True).alias("_hot"))
    cold = table.filter(F.col(n) <= limit).select(*named, *values)
    marked = rows.join(F.broadcast(hot.select(*aliases, "_hot")), on(rows, hot), "left")
    rest = marked.filter("_hot IS NULL").select(*rows.columns)
    near = rows.join(F.broadcast(hot.drop("_hot")), on(rows, hot)).select(*rows.columns, *values)
    far = rest.join(cold, on(rest, cold)).select(*rows.columns, *values)
    return near.unionByName(far)


def join_hashed(rows: DataFrame, table: DataFrame, key: str, n: str) -> DataFrame:
    """``join_counted`` for one key that is a 64-bit hash and never null.

    The hot keys, fewer than 1024 numbers, become constants of the plan: rows are told
    apart by a filter, and no row passes through a join only to be left out.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    limit = max(total // HOT_PARTS, 1)
    hot = F.col(key).isin([k for k, in table.filter(F.col(n) > limit).select(key).collect()])
    near = rows.filter(hot).join(F.broadcast(table.filter(hot).drop(n)), key)
    return near.unionByName(rows.filter(~hot).join(table.filter(~hot).drop(n), key))


def join_salted(left: DataFrame, right: DataFrame, keys: Sequence[str], part: int = 1 << 12) -> DataFrame:
    """Inner join in which the rows of ``left`` with one key are dealt to tasks of about ``part`` rows.

    The rows of ``right`` with such a key are repeated once for each of these parts. For
    many-to-many joins; keys are not null. ``left`` is read twice, so it should be a
    written table.
    """
    large = left.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > part).select(
        *keys, F.ceil(F.col("_n") / part).cast("int").alias("_parts"))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    dealt = left.join(large, list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop("_parts")
    repeated = right.join(large, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(repeated, [*keys, "_salt"]).drop("_salt")
