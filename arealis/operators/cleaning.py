"""Projection, cleaning and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import clean_integer, safe_name
from .skew import task_count


def clean_numeric(df: DataFrame, text_columns: Sequence[str], null_token: str = "-") -> DataFrame:
    """Every column outside ``text_columns`` becomes bigint (see ``clean_integer``)."""
    return df.select(*[
        F.col(f"`{c}`") if c in text_columns else clean_integer(F.col(f"`{c}`"), null_token).alias(c)
        for c in df.columns])


def housing_extract(df: DataFrame, codes: DataFrame, code: str, *, geography: str = "GEOGRAPHY",
                    band: str = "BAND", key: str = "ECODE", out_key: str = "loc",
                    level: str = "LSOA", total: str = "All") -> DataFrame:
    """Rows of one geography level and the total band, limited to valid codes."""
    kept = df.filter((F.col(band) == total) & (F.col(geography) == level))
    valid = codes.select(F.col(code).alias(key)).distinct()
    joined = kept.join(valid, key, "inner").fillna(0)
    return joined.withColumnRenamed(key, out_key).drop(geography, band)


def harmonise_columns(df: DataFrame, positions: Sequence[int] | None = None,
                      mapping: Mapping[str, str] | None = None,
                      order: Sequence[str] | None = None) -> DataFrame:
    """Keep columns by position, rename source headers, select in the wanted order."""
    names = df.columns if positions is None else [df.columns[i] for i in positions]
    mapping = mapping or {}
    renamed = df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in names])
    return renamed if order is None else renamed.select(*[F.col(f"`{c}`") for c in order])


def sanitize_names(df: DataFrame) -> DataFrame:
    """Column names with non-word characters replaced by underscores."""
    return df.toDF(*[safe_name(c) for c in df.columns])


def positional_names(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Columns renamed to f0, f1, ... and the original names."""
    return df.toDF(*[f"f{i}" for i in range(len(df.columns))]), list(df.columns)


def filter_prefix(df: DataFrame, code: str, prefix: str, name: str | None = None,
                  part: str | None = None) -> DataFrame:
    """Codes with a prefix, or (optionally) names that contain a text."""
    keep: Column = F.col(code).startswith(prefix)
    if name is not None and part is not None:
        keep = keep | F.col(name).contains(part)
    return df.filter(keep)


def filter_nonnull_points(df: DataFrame, allowed: DataFrame, location: str, lon: str, lat: str,
                          month: str) -> DataFrame:
    """Rows with complete coordinates and month at an allowed location.

    The rows are dealt out by location in as many tasks as they need, not merged: grouping
    points afterwards goes on in these tasks.
    """
    complete = df.filter(F.col(location).isNotNull() & F.col(lon).isNotNull() & F.col(lat).isNotNull()
                         & F.col(month).isNotNull())
    tasks = task_count(df.sparkSession, df.count())
    return complete.repartition(tasks, location).join(allowed.select(location), location, "left_semi")


def drop_bad_rows(df: DataFrame, columns: Sequence[str],
                  product: tuple[str, str, str] | None = None) -> DataFrame:
    """Cast to double, add a product column (name, left, right), drop NULL and infinite rows."""
    df = df.withColumns({c: F.col(c).cast("double") for c in columns})
    if product is not None:
        name, left, right = product
        df = df.withColumn(name, F.col(left) * F.col(right))
    df = df.dropna(subset=list(columns))
    finite = F.lit(True)
    for c in columns:
        finite = finite & (F.abs(F.col(c)) != float("inf"))
    return df.filter(finite)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """First row per key in an explicit order (default: all other columns).

    ``row_number() = 1`` is planned as a group limit before and after the shuffle,
    so a key with a third of all rows sends one row per map task.
    """
    order = list(order) if order else [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
