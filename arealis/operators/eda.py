"""Descriptive aggregates of events, lookups and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from ..session import cut_lineage
from .skew import exact_quantiles


def top_locations(df: DataFrame, location: str, n: int = 5, count: str = "n_events") -> DataFrame:
    """The n locations with most events (ties: smaller code)."""
    return df.groupBy(location).agg(F.count("*").alias(count)).orderBy(F.desc(count), location).limit(n)


def basic_stats(df: DataFrame, location: str, date: str) -> DataFrame:
    """Events, date range, locations, mean and deviation of the monthly counts.

    Events are first counted per location and month; both levels of statistics come
    from that small table.
    """
    cells = df.groupBy(location, date).agg(F.count("*").alias("_n"))
    monthly = cells.groupBy(date).agg(F.sum("_n").alias("_n"))
    per_month = monthly.agg(
        F.sum("_n").cast("bigint").alias("total_events"), F.min(date).alias("first_date"),
        F.max(date).alias("last_date"), F.avg("_n").alias("avg_per_month"),
        F.stddev_samp("_n").alias("std_per_month"))
    locations = cells.select(F.countDistinct(location)).scalar()
    return per_month.withColumn("n_locations", locations)


def year_month_pivot(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Years as rows, the twelve months as columns m1..m12."""
    counts = df.groupBy(year, month).agg(F.count("*").alias("_n"))
    wide = counts.groupBy(year).pivot(month, list(range(1, 13))).sum("_n")
    return wide.select(year, *[F.col(f"`{m}`").cast("bigint").alias(f"m{m}") for m in range(1, 13)])


def hierarchy_counts(lookup: DataFrame, levels: Sequence[str], unchanged: tuple[str, str, str],
                     subset=None) -> DataFrame:
    """Distinct codes per level and distinct unchanged codes, for the whole table and
    a subset, with the subset's share. ``unchanged`` is (code, flag column, flag)."""
    code, flag, keep = unchanged
    columns = {f"n_{c}": F.col(c) for c in levels}
    columns["n_unchanged"] = F.when(F.col(flag) == keep, F.col(code))
    inside = F.lit(True) if subset is None else subset
    counts = [F.countDistinct(c).alias(n) for n, c in columns.items()]
    if subset is None:
        return lookup.agg(*counts)
    counts += [F.countDistinct(F.when(inside, c)).alias(f"sub_{n}") for n, c in columns.items()]
    shares = [F.try_divide(F.col(f"sub_n_{c}").cast("double"), F.col(f"n_{c}").cast("double"))
              .alias(f"share_{c}") for c in levels]
    return lookup.agg(*counts).select("*", *shares)


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, nulls, mean, deviation, minimum, quartiles, maximum.

    Columns that are no numbers (text, dates) have their smallest and greatest value, as
    text, in ``min_text``/``max_text``.
    """
    text = [f.name for f in df.schema.fields if f.name in columns and not isinstance(f.dataType, NumericType)]
    quart = exact_quantiles(df, [c for c in columns if c not in text], (0.25, 0.5, 0.75))
    none, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    rows = []
    for c in columns:
        number = c not in text
        x = F.col(c).cast("double") if number else none
        q1, q2, q3 = (F.lit(v).cast("double") for v in (quart[c] if number else (None,) * 3))
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("n"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("n_null"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), q1.alias("p25"), q2.alias("p50"),
            q3.alias("p75"), F.max(x).alias("max"),
            (no_text if number else F.min(c).cast("string")).alias("min_text"),
            (no_text if number else F.max(c).cast("string")).alias("max_text")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def residential_stats(df: DataFrame, share: str = "residential_pct_2018",
                      flag: str = "is_residential_dominant",
                      advantage: str = "residential_advantage") -> DataFrame:
    """Mean and median share, flagged and total count, advantage among the flagged."""
    df = cut_lineage(df.select(share, flag, advantage))
    median = exact_quantiles(df, [share], (0.5,))[share][0]
    lead = F.when(F.col(flag), F.col(advantage))
    return df.agg(
        F.avg(share).alias("avg_share"), F.count(F.when(F.col(flag), 1)).alias("n_flagged"),
        F.count("*").alias("n_total"), F.avg(lead).alias("avg_advantage"),
        F.min(lead).alias("min_advantage"), F.max(lead).alias("max_advantage"),
    ).withColumns({
        "median_share": F.lit(median).cast("double"),
        "pct_flagged": F.try_divide(F.col("n_flagged") * F.lit(100.0), F.col("n_total"))})


def borough_summary(roster: DataFrame, name: str = "lad_name", officers: str = "officers_assigned",
                    score: str = "score") -> DataFrame:
    return roster.groupBy(name).agg(
        F.sum(officers).cast("bigint").alias("total_officers"),
        F.avg(score).alias("avg_prediction_score")).orderBy(F.desc("total_officers"), name)


def actual_vs_predicted(df: DataFrame, location: str, actual: str, predicted: str) -> DataFrame:
    """Mean per location and month, then per month."""
    cells = df.groupBy("year", "month", location).agg(
        F.avg(actual).alias("_a"), F.avg(predicted).alias("_p"))
    return cells.groupBy("year", "month").agg(
        F.avg("_a").alias("avg_actual"), F.avg("_p").alias("avg_predicted"))


def avg_curve_rmse(df: DataFrame, part: str, actual: str, predicted: str) -> DataFrame:
    """RMSE between the averaged monthly curves, per part (train, test)."""
    curve = df.groupBy(part, "year", "month").agg(F.avg(actual).alias("_a"), F.avg(predicted).alias("_p"))
    return curve.groupBy(part).agg(
        F.count("*").alias("n_months"),
        F.sqrt(F.avg(F.pow(F.col("_a") - F.col("_p"), 2))).alias("curve_rmse"))


def max_normalise(df: DataFrame, value: str, out: str) -> DataFrame:
    """Value as a share of the column's maximum."""
    top = df.select(F.max(value)).scalar()
    return df.withColumn(out, F.try_divide(F.col(value).cast("double"), top.cast("double")))


def log_counts(df: DataFrame, count: str) -> DataFrame:
    """ln(1 + count), and log2(count) that is NULL for 0."""
    x = F.col(count).cast("double")
    return df.withColumns({"log1p_count": F.log1p(x), "log2_count": F.when(x > 0, F.log2(x))})
