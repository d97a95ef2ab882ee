"""Daily and hourly workforce rosters from scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import let, safe_div

# Reference counts of events per hour of the day, hours 0 to 23.
HOURLY_COUNTS = (
    100, 80, 50, 40, 150, 600, 1550, 2050,
    1780, 1320, 980, 680, 520, 450, 480, 550,
    620, 780, 850, 830, 740, 705, 690, 500,
)
# Officers per ward and day, hours each of them gives.
OFFICERS_PER_WARD = 100
HOURS_PER_OFFICER = 2


@dataclass(frozen=True)
class HourProfile:
    """Arrays of 24: share of each hour, and its 1-based rank (ties: earlier hour first)."""

    share: Column
    rank: Column


def hour_profile(counts: Sequence[float] = HOURLY_COUNTS) -> HourProfile:
    """Profile of fixed counts; uniform when they sum to 0 or less."""
    total = float(sum(counts))
    share = [c / total for c in counts] if total > 0 else [1.0 / 24] * 24
    order = sorted(range(24), key=lambda h: (-share[h], h))
    rank = [order.index(h) + 1 for h in range(24)]
    return HourProfile(F.array(*[F.lit(s) for s in share]), F.array(*[F.lit(r) for r in rank]))


def hourly_counts(df: DataFrame, timestamp: str, hour: str = "hour", count: str = "n") -> DataFrame:
    """Events per hour of the day."""
    return df.groupBy(F.hour(timestamp).alias(hour)).agg(F.count("*").alias(count))


def hourly_fractions(counts: DataFrame, hour: str = "hour", count: str = "n") -> DataFrame:
    """All 24 hours with count, share of the total (uniform if it is 0) and rank.

    The counts are folded into one 24-entry map first, so whatever the input holds,
    only 24 rows are ranked.
    """
    folded = counts.filter(F.col(hour).between(0, 23)).groupBy(F.col(hour).cast("int").alias("h")).agg(
        F.sum(count).alias("c")).agg(F.map_from_entries(F.collect_list(F.struct("h", "c"))).alias("m"))
    hours = folded.select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"), "m").select(
        "hour", F.coalesce(F.try_element_at("m", F.col("hour")), F.lit(0)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    share = F.when(total > 0, safe_div(F.col("n"), total)).otherwise(F.lit(1.0 / 24))
    return hours.withColumn("fraction", share).withColumn(
        "rank", F.row_number().over(everything.orderBy(F.col("fraction").desc(), "hour")))


def profile_of(fractions: DataFrame) -> HourProfile:
    """The 24 rows of ``hourly_fractions`` as a profile (scalar subqueries)."""
    def column(name: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct("hour", name)))
        return fractions.select(F.transform(rows, lambda r: r[name])).scalar()

    return HourProfile(column("fraction"), column("rank"))


def score_grid(areas: DataFrame, scores: DataFrame, months: DataFrame | Sequence[str], *,
               location: str = "loc", month: str = "month_key", score: str = "score") -> DataFrame:
    """Every area with every target month; a missing score is 0."""
    if isinstance(months, DataFrame):
        wanted = months.select(F.sort_array(F.collect_set(months.columns[0]))).scalar()
    else:
        wanted = F.array(*[F.lit(m) for m in months])
    folded = scores.groupBy(location).agg(
        F.map_from_entries(F.collect_list(F.struct(month, score))).alias("_scores"))
    return (areas.join(folded, location, "left").withColumn(month, F.explode(wanted))
            .withColumn(score, F.coalesce(F.try_element_at("_scores", F.col(month)), F.lit(0))
                        .cast("double")).drop("_scores"))


def allocate_daily(df: DataFrame, group: Sequence[str] = ("lad", "ward", "month_key"),
                   score: str = "score", *, officers: int = OFFICERS_PER_WARD) -> DataFrame:
    """Officers per location and day, in proportion to its score within the ward.

    All months at once. The ward total is a pre-aggregated sum joined back, so a
    ward with very many locations is not gathered in one task. Shares are rounded to
    9 decimals before the floor, which makes it independent of the summation order;
    a positive score gets at least one officer.
    """
    totals = df.groupBy(*group).agg(F.sum(score).alias("_total"))
    part = F.floor(F.round(F.col(score) / F.col("_total") * officers, 9)).cast("int")
    given = F.when(F.col("_total") > 0, F.when((F.col(score) > 0) & (part < 1), 1).otherwise(part)
                   ).otherwise(0)
    return df.join(totals, list(group)).withColumn("officers_assigned", given).drop("_total")


def _slots(df: DataFrame, daily: str, profile: HourProfile, finish) -> DataFrame:
    """Adds ``_slots``: ``finish(floors, their sum, rank array)`` per roster row."""
    def floors(share: Column) -> Column:
        return F.transform(share, lambda f: F.floor(F.col(daily) * f).cast("int"))

    bound = df.withColumns({"_share": profile.share, "_rank": profile.rank})
    slots = let(floors(F.col("_share")), lambda base: let(
        _total(base), lambda total: finish(base, total, F.col("_rank"))))
    return bound.withColumn("_slots", slots).drop("_share", "_rank")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, v: acc + v)


def allocate_hourly_bump(df: DataFrame, profile: HourProfile, daily: str = "officers_assigned") -> DataFrame:
    """24 rows per roster row; a positive day that floors to nothing gets one officer
    in the busiest hour (the first of equals)."""
    def bump(base: Column, total: Column, rank: Column) -> Column:
        return F.when((F.col(daily) > 0) & (total == 0),
                      F.transform(rank, lambda r: (r == 1).cast("int"))).otherwise(base)

    slots = _slots(df, daily, profile, bump).select(
        *[c for c in df.columns if c != daily], F.posexplode("_slots").alias("hour", daily))
    return slots.withColumn("hour_block", F.format_string("%02d:00–%02d:59", "hour", "hour"))


def allocate_hourly_remainder(df: DataFrame, profile: HourProfile, daily: str = "officers_assigned",
                              out: str = "hourly") -> DataFrame:
    """24-slot array per roster row: floors, then one more officer in each of the
    busiest hours until the day's number is reached (at most one extra per hour)."""
    def fill(base: Column, total: Column, rank: Column) -> Column:
        more = F.when(F.col(daily) > 0, F.col(daily) - total).otherwise(0)
        return let(more, lambda m: F.zip_with(base, rank, lambda b, r: b + (r <= m).cast("int")))

    return _slots(df, daily, profile, fill).withColumnRenamed("_slots", out)
