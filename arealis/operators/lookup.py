"""Joins with dimensions: area lookups, code changes, snapshots, membership.

No join carries a broadcast hint: the optimiser broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` (from file sizes, or at run time from the
real size of a shuffle stage) and splits hot keys of the larger side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .cleaning import dedup_first


def build_lookup(frames: Sequence[DataFrame], key: str, order: Sequence[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """Chain of left joins on one key, fixed column order, optional row filter."""
    joined = reduce(lambda left, right: left.join(right, key, "left"), frames)
    if order is not None:
        joined = joined.select(*[c for c in order if c in joined.columns])
    return joined if where is None else joined.filter(where)


def change_table(lookup: DataFrame, old: str, new: str, flag: str,
                 changed: Sequence[str] = ("S", "M", "X")) -> DataFrame:
    """One target per changed code; a split code maps to its greatest new code."""
    return (lookup.filter(F.col(flag).isin(*changed)).groupBy(F.col(old).alias("_old"))
            .agg(F.max(new).alias("_new")))


def recode_location(df: DataFrame, location: str, lookup: DataFrame, old: str, new: str,
                    flag: str) -> DataFrame:
    """Replace codes that changed, keep the others."""
    changes = change_table(lookup, old, new, flag)
    return (df.join(changes, F.col(location) == F.col("_old"), "left")
            .withColumn(location, F.coalesce("_new", location)).drop("_old", "_new"))


def collect_events(raw: DataFrame, lookup: DataFrame, *, kind: str, id_col: str = "Crime ID",
                   code: str = "LSOA code", type_col: str = "Crime type", old: str = "LSOA11CD",
                   new: str = "LSOA21CD", flag: str = "CHGIND") -> DataFrame:
    """Raw rows -> cleaned events: trim and recode the code, keep valid rows of one
    type that carry an id, one row per id.

    The type and id filters come first so that they reach the scan.
    """
    kept = raw.filter((F.col(f"`{type_col}`") == kind) & (F.trim(F.col(f"`{id_col}`")) != ""))
    kept = kept.withColumn(code, F.trim(F.col(f"`{code}`").cast("string")).cast(
        raw.schema[code].dataType))
    recoded = recode_location(kept, code, lookup, old, new, flag)
    valid = lookup.select(F.col(new).alias(code)).distinct()
    inside = recoded.join(valid, code, "left_semi").select(*[F.col(f"`{c}`") for c in raw.columns])
    return dedup_first(inside, [id_col])


def semi_filter(df: DataFrame, location: str, classes: DataFrame, key: str,
                flag: str = "is_residential_dominant") -> DataFrame:
    """Rows whose location carries the flag."""
    flagged = classes.filter(F.col(flag)).select(F.col(key).alias(location))
    return df.join(flagged, location, "left_semi")


def version_union(versions: Sequence[tuple[DataFrame, int, int | None]]) -> DataFrame:
    """Stack yearly versions (frame, first year, last year or None) with their validity."""
    frames = [f.withColumns({"valid_from": F.lit(first), "valid_to": F.lit(9999 if last is None else last)})
              for f, first, last in versions]
    return reduce(lambda a, b: a.unionByName(b), frames)


def snapshot_join(df: DataFrame, snapshots: DataFrame, location: str, year: str = "year",
                  first_year: int | None = None) -> DataFrame:
    """Attach the snapshot valid in the row's year.

    One left join on the location with the validity range as residual condition;
    rows before the first snapshot year are dropped.
    """
    if first_year is None:
        first = snapshots.select(F.min("valid_from")).scalar()
    else:
        first = F.lit(first_year)
    right = snapshots.withColumnRenamed(location, "_loc")
    return (df.filter(F.col(year) >= first)
            .join(right, (F.col(location) == F.col("_loc"))
                  & F.col(year).between(F.col("valid_from"), F.col("valid_to")), "left")
            .drop("_loc", "valid_from", "valid_to"))


def dimension_join(df: DataFrame, dimension: DataFrame, location: str,
                   drop: Sequence[str] = ()) -> DataFrame:
    """Left join of a location dimension; its numbers are 0 where it has no row."""
    dim = dimension.drop(*drop)
    values = [c for c in dim.columns if c != location]
    return df.join(dim, location, "left").fillna(0, subset=values)


def recode_average(df: DataFrame, lookup: DataFrame, key: str, old: str, new: str,
                   out: str = "loc") -> DataFrame:
    """Numbers per old code -> mean per new code; every new code is kept."""
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("byte", "short", "integer", "long", "float",
                                            "double", "decimal") and f.name != key]
    one = dedup_first(df, [key])
    pairs = lookup.select(F.col(old).alias(key), F.col(new).alias(out))
    return pairs.join(one, key, "left").groupBy(out).agg(
        *[F.avg(F.col(f"`{c}`")).alias(c) for c in numeric])


def map_first_match(df: DataFrame, lookup: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Attach the first new code of each old code; NULL where there is none."""
    first = lookup.groupBy(F.col(old).alias(key)).agg(F.min(new).alias(new))
    return df.join(first, key, "left")


def inner_rate(counts: DataFrame, rates: DataFrame, key: str) -> DataFrame:
    return counts.join(rates, key, "inner")


def fill_missing_counts(dimension: DataFrame, counts: DataFrame, location: str, count: str) -> DataFrame:
    """Every location of the dimension with its count, 0 where it has none."""
    return dimension.join(counts, location, "left").fillna(0, subset=[count])


def allowed_locations(events: DataFrame, location: str, classes: DataFrame, key: str,
                      flag: str = "is_residential_dominant") -> DataFrame:
    """Locations that occur in the events and carry the flag."""
    seen = events.select(location).filter(F.col(location).isNotNull())
    flagged = classes.filter(F.col(flag)).select(F.col(key).alias(location))
    return seen.intersect(flagged)
