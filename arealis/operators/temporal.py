"""Time-series features of a panel: one shuffle by location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import series as s
from ..functions.scalars import clip_lower
from ..session import cut_lineage
from .skew import numbered_rows, task_count

LAGS = (1, 3, 6, 12)
EWM_SPANS = (6, 12)
TEMA_SPAN = 6
HULL_PERIODS = (4, 5)


def add_lags(df: DataFrame, location: str, target: str, order: Sequence[str],
             lags: Sequence[int] = LAGS) -> DataFrame:
    w = s.series_window(location, *order)
    return df.withColumns({f"{target}_lag_{k}": s.lagged(F.col(target), k, w) for k in lags})


def add_ewm(df: DataFrame, location: str, target: str, order: Sequence[str],
            spans: Sequence[int] = EWM_SPANS, *, long: bool = False) -> DataFrame:
    """Exponential means up to the row before, for series of any length.

    One window holds a whole series; ``long`` is for series that a task cannot hold: their
    rows are numbered in parallel, and a task gathers no more than blocks of them.
    """
    if long:
        return _add_ewm_long(df, location, target, order, spans)
    df, t, block, inner, w = _blocks(df, location, order, spans)
    x = F.col(target)
    df = df.withColumns({f"_p{n}": s.ewm_inner(x, n, t, block, inner) for n in spans})
    df = df.withColumns({f"_p{n}": s.ewm_whole(F.col(f"_p{n}"), n, t, block, w) for n in spans})
    df = df.withColumns({f"{target}_ewm_{n}": s.lagged(F.col(f"_p{n}"), 1, w) for n in spans})
    return df.drop("_t", "_block", *[f"_p{n}" for n in spans])


def _add_ewm_long(df: DataFrame, location: str, target: str, order: Sequence[str], spans: Sequence[int]) -> DataFrame:
    """The parts within the blocks by windows of one block each; what the blocks before have
    left comes from a table with a row per block."""
    block, columns = s.ewm_block(spans), df.columns
    rows = cut_lineage(numbered_rows(df, [location], order, "_t").withColumn("_t", F.col("_t") - 1)
                       .withColumn("_block", F.floor(F.col("_t") / block)))
    t, x = F.col("_t"), F.col(target)
    rest = {n: F.lit(1.0 - 2.0 / (n + 1)) for n in spans}
    ends = rows.groupBy(F.col(location).alias("_at"), F.col("_block").alias("_b")).agg(
        *[F.when(F.count("*") == block, F.sum(s.ewm_term(x, n, t, block)) * F.pow(rest[n], F.lit(block - 1))).alias(f"_end{n}")
          for n in spans])
    along = Window.partitionBy("_at").orderBy("_b")
    ends = ends.withColumns({f"_left{n}": F.coalesce(F.last(f"_end{n}", True).over(
        along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) for n in spans})
    ends = ends.withColumns({f"_first{n}": F.lag(F.col(f"_end{n}") + F.col(f"_left{n}") * F.pow(rest[n], F.lit(block)), 1).over(along)
                             for n in spans})
    ends = cut_lineage(ends.drop(*[f"_end{n}" for n in spans]))
    parts = task_count(df.sparkSession, rows.count())
    inner = Window.partitionBy(location, "_block").orderBy("_t")
    placed = rows.repartition(parts, location, "_block")
    placed = placed.withColumns({f"_p{n}": s.ewm_inner(x, n, t, block, inner) for n in spans})
    placed = placed.withColumns({f"_p{n}": F.lag(f"_p{n}", 1).over(inner) for n in spans})
    j = t % block
    whole = {f"{target}_ewm_{n}": F.when(j == 0, F.col(f"_first{n}")).otherwise(
        F.col(f"_p{n}") + F.col(f"_left{n}") * F.pow(rest[n], j)) for n in spans}
    on = F.col(location).eqNullSafe(F.col("_at")) & (F.col("_block") == F.col("_b"))
    return placed.join(ends, on).select(*columns, *[c.alias(name) for name, c in whole.items()])


def add_tema(df: DataFrame, location: str, target: str, order: Sequence[str],
             span: int = TEMA_SPAN) -> DataFrame:
    df, t, block, inner, w = _blocks(df, location, order, (span,))
    df = df.withColumn("_e1", s.ewm_inner(F.col(target), span, t, block, inner))
    df = df.withColumn("_e1", s.ewm_whole(F.col("_e1"), span, t, block, w))
    df = _tema_tail(df, target, span, t, block, inner, w)
    return df.drop("_t", "_block")


def add_hull(df: DataFrame, location: str, target: str, order: Sequence[str],
             periods: Sequence[int] = HULL_PERIODS) -> DataFrame:
    w = s.series_window(location, *order)
    df = df.withColumns({f"_h{n}": s.hull_inner(F.col(target), n, w) for n in periods})
    df = df.withColumns({f"{target}_hma_{n}": s.hull_outer(F.col(f"_h{n}"), n, w)
                         for n in periods})
    return df.drop(*[f"_h{n}" for n in periods])


def add_repeat_risk(df: DataFrame, location: str, target: str, order: Sequence[str],
                    max_lag: int = 24, prob: float = 0.134,
                    out: str = "revictimization_risk") -> DataFrame:
    w = s.series_window(location, *order)
    return df.withColumn(out, s.repeat_risk(F.col(target), w, max_lag, prob))


def add_temporal_features(df: DataFrame, location: str = "loc", target: str = "count",
                          order: Sequence[str] = ("year", "month"), *,
                          risk: bool = False) -> DataFrame:
    """All series features; ``risk=True`` adds the repeat-event risk in the same pass.

    Features that depend on each other are staged (row number; parts of the exponential
    means within blocks of rows; the means; and so on), and every stage is a Window
    operator on the same partitioning. All but the row number use one order, location,
    block and time, so the panel is shuffled once and sorted twice. The independent
    features are spread over the stages: a projection with all of them would exceed the
    method size the JVM compiles.
    """
    spans = sorted({*EWM_SPANS, TEMA_SPAN})
    df, t, block, inner, w = _blocks(df, location, order, spans)
    x = F.col(target)

    df = df.withColumns({f"_p{n}": s.ewm_inner(x, n, t, block, inner) for n in spans})
    first: dict[str, Column] = {f"{target}_lag_{k}": s.lagged(x, k, w) for k in LAGS}
    first.update({f"_p{n}": s.ewm_whole(F.col(f"_p{n}"), n, t, block, w) for n in spans})
    first.update({f"_h{n}": s.hull_inner(x, n, w) for n in HULL_PERIODS})
    df = df.withColumns(first).withColumn("_e1", F.col(f"_p{TEMA_SPAN}"))

    second = {f"{target}_ewm_{n}": s.lagged(F.col(f"_p{n}"), 1, w) for n in EWM_SPANS}
    second.update({f"{target}_hma_{n}": s.hull_outer(F.col(f"_h{n}"), n, w) for n in HULL_PERIODS})
    second[f"{target}_sum_12"] = s.rolling_sum(x, 12, w)
    second[f"{target}_active_3"] = s.active(x, 3, w)
    second[f"{target}_pct_change"] = s.pct_change(x, 3, 6, w)
    second[f"{target}_volatility_6m"] = s.volatility(x, 6, w, shift=3)
    second[f"{target}_trend_ratio"] = s.trend_ratio(x, 3, w, near=3, far=9)
    third = {"revictimization_risk": s.repeat_risk(x, w)} if risk else {}
    df = _tema_tail(df, target, TEMA_SPAN, t, block, inner, w, second, third)
    return df.select(*feature_order(df, target))


def feature_order(df: DataFrame, target: str) -> list[str]:
    """Input columns first, then the features in their documented order."""
    features = (
        [f"{target}_lag_{k}" for k in LAGS] + [f"{target}_ewm_{n}" for n in EWM_SPANS]
        + [f"{target}_tema_{TEMA_SPAN}"] + [f"{target}_hma_{n}" for n in HULL_PERIODS]
        + [f"{target}_{n}" for n in ("sum_12", "active_3", "pct_change", "volatility_6m",
                                     "trend_ratio")]
        + [c for c in ("revictimization_risk",) if c in df.columns])
    hidden = {"_t", "_block"} | {f"_h{n}" for n in HULL_PERIODS} | {
        f"_p{n}" for n in {*EWM_SPANS, TEMA_SPAN}}
    return [c for c in df.columns if c not in features and c not in hidden] + features


def _blocks(df: DataFrame, location: str, order: Sequence[str], spans: Sequence[int]):
    """Adds the row number ``_t`` and its block; the windows of a block and of the series.

    The block grows with the time, so ordering by it first changes nothing, and both
    windows share one sort.
    """
    block = s.ewm_block(spans)
    df = df.withColumn("_t", F.row_number().over(s.series_window(location, *order)) - 1)
    df = df.withColumn("_block", F.floor(F.col("_t") / block))
    inner = Window.partitionBy(location, "_block").orderBy(*order)
    return df, F.col("_t"), block, inner, s.series_window(location, "_block", *order)


def _tema_tail(df: DataFrame, target: str, span: int, t: Column, block: int, inner, w,
               second_extra: dict[str, Column] | None = None,
               third_extra: dict[str, Column] | None = None) -> DataFrame:
    """Second and third exponential pass; everything ends one row back."""
    df = df.withColumns({"_e2": s.ewm_inner(F.col("_e1"), span, t, block, inner)})
    df = df.withColumns({"_e2": s.ewm_whole(F.col("_e2"), span, t, block, w), **(second_extra or {})})
    df = df.withColumns({"_e3": s.ewm_inner(F.col("_e2"), span, t, block, inner)})
    df = df.withColumns({"_e3": s.ewm_whole(F.col("_e3"), span, t, block, w), **(third_extra or {})})
    value = s.lagged(F.col("_e1") * 3 - F.col("_e2") * 3 + F.col("_e3"), 1, w)
    return df.withColumn(f"{target}_tema_{span}", clip_lower(value)).drop("_e1", "_e2", "_e3")


def last_row_per_location(df: DataFrame, location: str, order: Sequence[str]) -> DataFrame:
    """Latest row of each location.

    A rank filter of 1 is a group limit in Spark: every map task keeps one row per
    location before the shuffle, so a location with very many rows moves few.
    """
    w = s.Window.partitionBy(location).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def naive_forecast(df: DataFrame, location: str, date: str, names: DataFrame | None = None,
                   name_key: str | None = None, out: str = "predicted") -> DataFrame:
    """Count of the latest month that has rows, per location, with the area name."""
    monthly = df.groupBy(location, date).agg(F.count("*").alias("_n"))
    last = monthly.groupBy(location).agg(F.max_by("_n", date).alias(out))
    if names is None:
        return last
    key = name_key or location
    return last.join(names.withColumnRenamed(key, location), location, "left")
