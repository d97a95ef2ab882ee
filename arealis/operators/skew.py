"""Helpers that keep results whole when one group holds much of the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from ..session import cut_lineage

#: Rows that one task sorts or gathers.
TASK_ROWS = 500_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows: ``TASK_ROWS`` each, one per core at least."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def is_small(df: DataFrame, limit: int) -> bool:
    """True if ``df`` has at most ``limit`` rows; reads no more than limit + 1 of them."""
    return df.limit(limit + 1).count() <= limit


def numbered_rows(df: DataFrame, group: Sequence[str], order: str | Sequence[str], out: str,
                  size: str | None = None) -> DataFrame:
    """Exact 1-based ordinal of each row in its group, without one task per group.

    ``order`` is a unique number, or columns that tell the rows apart. The rows are
    range-partitioned by group and order, by counted samples, so that a group of any size
    and with any values is spread over as many partitions as its rows need. Each partition
    is numbered as it is sorted, and the rows of the group in the partitions before are added.
    """
    keys = [*group, *([order] if isinstance(order, str) else order)]
    parts = task_count(df.sparkSession, df.count())
    placed = cut_lineage(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                         .withColumn("_id", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_id", 33)))
    per_part = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_n").over(
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    offsets = per_part.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_at"), "_first",
        before.alias("_before"), F.sum("_n").over(Window.partitionBy(*group)).alias("_size"))
    on = F.col("_part") == F.col("_at")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    numbered = placed.join(offsets, on).withColumn(
        out, (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("bigint"))
    if size is not None:
        numbered = numbered.withColumn(size, F.col("_size").cast("bigint"))
    return numbered.drop("_id", "_part", "_at", "_first", "_before", "_size",
                         *[f"_g{i}" for i in range(len(group))])


#: Bins that a read divides a bracket into, on a linear and on a logarithmic scale; values of one bracket that the driver takes.
ACCURACY, GRID, BRACKET = 20_000, 512, 1 << 16


class _Search:
    """A run of the finite values of one column in order, ``low`` to ``high`` (both in the data),
    that holds the wanted ``ranks``; ``before`` values come before it."""

    def __init__(self, column: int, ranks: Sequence[int], low: float, high: float, before: int, inside: int,
                 wide: bool = False):
        self.column, self.ranks, self.low, self.high = column, list(ranks), low, high
        self.before, self.inside = before, inside
        #: Divide on a logarithmic scale: most values of a linear division were in one bin.
        self.wide = wide

    def holds(self, x: Column) -> Column:
        return (x >= self.low) & (x <= self.high)

    def bin(self, x: Column) -> Column:
        """Number that never falls as x grows."""
        bins, (at, first, last) = ACCURACY, (x, self.low, self.high)
        if self.wide:
            unit = max(max(abs(self.low), abs(self.high)) * 1e-300, 5e-324)
            log = [math.copysign(math.log1p(abs(v) / unit), v) for v in (self.low, self.high)]
            if log[0] < log[1]:
                bins, (first, last) = GRID, log
                at = F.signum(x) * F.log1p(F.abs(x) / unit)
        if math.isinf(last - first):
            at, first, last = at / 2, first / 2, last / 2
        return F.least(F.greatest(F.floor((at - first) / (last - first) * bins), F.lit(0)), F.lit(bins - 1))

    def narrow(self, rows: list[Row], found: dict[tuple[int, int], float]) -> list[_Search]:
        """Takes the counted bins; gives back the searches that are still to be made."""
        rest, start = [], self.before
        for row in sorted(rows, key=lambda r: r["bin"]):
            ranks = [r for r in self.ranks if start <= r < start + row["n"]]
            if ranks and row["low"] == row["high"]:
                found.update({(self.column, r): row["low"] for r in ranks})
            elif ranks:
                rest.append(_Search(self.column, ranks, row["low"], row["high"], start, row["n"],
                                    not self.wide and row["n"] > self.inside / 16))
            start += row["n"]
        return rest


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles with bounded memory, in a few reads of ``df``.

    Built-in exact percentiles keep every distinct value of a group in one task, and sketches
    sort what they read. Here a first read counts and takes the ends of every column; the next
    counts the values in equal bins between them, with the ends of each bin. A bin that
    holds a wanted rank is divided again, until it is one value, however often repeated, or at
    most ``BRACKET`` values, which the last read brings to the driver. Infinities and NaN, which
    sorts last, are counted once and take their ranks.
    """
    cols = list(columns)
    inf = float("inf")

    def finite(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x) & (x > -inf) & (x < inf), x)

    stats = df.agg(F.lit(1).alias("one"), *[f for i, c in enumerate(cols) for f in (
        F.count(c).alias(f"n{i}"), F.count(F.when(F.col(c).cast("double") == -inf, 1)).alias(f"low{i}"),
        F.count(finite(c)).alias(f"mid{i}"), F.count(F.when(F.col(c).cast("double") == inf, 1)).alias(f"high{i}"),
        F.min(finite(c)).alias(f"min{i}"), F.max(finite(c)).alias(f"max{i}"))]).first()

    found: dict[tuple[int, int], float] = {}  # (column, rank) -> value
    inner: dict[tuple[int, int], float] = {}  # the same with ranks among the finite values
    wanted: dict[int, list[tuple[int, int, float]]] = {}
    search: list[_Search] = []
    for i in range(len(cols)):
        n, first, mid = stats[f"n{i}"], stats[f"low{i}"], stats[f"mid{i}"]
        if not n:
            continue
        wanted[i] = []
        ranks = set()
        for p in probs:
            at = p * (n - 1)
            low = int(at)
            high = low + 1 if at > low else low
            wanted[i].append((low, high, at - low))
            for rank in {low, high}:
                if rank < first:
                    found[i, rank] = -inf
                elif rank in (first, first + mid - 1) and mid:
                    found[i, rank] = stats[f"min{i}"] if rank == first else stats[f"max{i}"]
                elif rank < first + mid:
                    ranks.add(rank - first)
                else:
                    found[i, rank] = inf if rank < first + mid + stats[f"high{i}"] else float("nan")
        if ranks:
            search.append(_Search(i, sorted(ranks), stats[f"min{i}"], stats[f"max{i}"], 0, mid))
    few: list[_Search] = []
    while search:
        few += [s for s in search if s.inside <= BRACKET or s.low == s.high]
        search = [s for s in search if s.inside > BRACKET and s.low < s.high]
        if search:
            marks = [F.when(s.holds(x), F.struct(F.lit(j).alias("j"), s.bin(x).alias("bin"), x.alias("x")))
                     for j, s in enumerate(search) for x in [finite(cols[s.column])]]
            counted = df.select(F.explode(F.array(*marks)).alias("e")).filter("e IS NOT NULL").groupBy(
                "e.j", "e.bin").agg(F.count("*").alias("n"), F.min("e.x").alias("low"), F.max("e.x").alias("high")).collect()
            search = [new for j, s in enumerate(search) for new in s.narrow([r for r in counted if r["j"] == j], inner)]
    many = [s for s in few if s.low < s.high]
    row = df.agg(*[F.sort_array(F.collect_list(F.when(s.holds(x), x))) for s in many for x in [finite(cols[s.column])]]
                 ).first() if many else ()
    for s, values in zip(many, row):
        inner.update({(s.column, r): values[r - s.before] for r in s.ranks})
    inner.update({(s.column, r): s.low for s in few if s.low == s.high for r in s.ranks})
    found.update({(i, r + stats[f"low{i}"]): v for (i, r), v in inner.items()})

    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        if i not in wanted:
            result[c] = [None] * len(probs)
            continue
        result[c] = []
        for low, high, part in wanted[i]:
            a, b = found[(i, low)], found[(i, high)]
            result[c].append(a if a == b or not part or a == -inf else a + (b - a) * part)
    return result


def stable_fraction(keys: Sequence[str | Column], seed: int = 42) -> Column:
    """Repeatable number in [0, 1) per key, whatever the partitioning of the rows."""
    text = F.concat_ws("|", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys],
                       F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0 ** 32)
