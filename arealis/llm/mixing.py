"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Each source is cut into blocks of equal size. Block k (from 0) of a source with weight w
is released at slot floor(k / w) and due at slot ceil((k + 1) / w); in every slot the
released block with the earliest deadline is next. The weights are exact ratios of whole
numbers. If these add up to ``grid`` at most, the schedule repeats after as many slots: one
period is laid out, whatever the size of the corpus, and every block finds its slot by
arithmetic. Otherwise the slots are laid out to the end of the mixture, one number a block.
In every prefix, each source has its target share of the slots to less than one block.
"""

from __future__ import annotations

import heapq
import json
import math
from array import array
from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from arealis.session import cut_lineage

BLOCK_ROWS = 16
#: Longest period that is laid out once and repeated.
GRID = 1000
#: Slots in one row of the table of slots.
SLOT_ROWS = 1000
TEMPER = 0.9
#: Sources whose names and sizes fit the driver; more than these are refused.
MAX_SOURCES = 100_000
#: Rows numbered by one task.
BUCKET_ROWS = 4_000
#: Slots that are sent to all rows; a longer table is joined as the optimiser decides.
BROADCAST_SLOTS = 1 << 20


def grid_weights(weights: dict[str, float], grid: int) -> dict[str, int]:
    """Whole parts of ``grid``, at least one each, by largest remainders."""
    grid = max(grid, 10 * len(weights))
    total = sum(weights.values())
    exact = {s: w / total * (grid - len(weights)) for s, w in weights.items()}
    parts = {s: int(x) + 1 for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    for s in rest[:grid - sum(parts.values())]:
        parts[s] += 1
    return parts


def period(parts: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source in one period: earliest deadline among the released blocks."""
    grid = sum(parts.values())
    waiting = [(0, s, 0) for s in sorted(parts)]
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {s: [] for s in parts}
    for slot in range(grid):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * grid // parts[s]), s, k))
        _, s, k = heapq.heappop(ready)
        slots[s].append(slot)
        if k + 1 < parts[s]:
            heapq.heappush(waiting, ((k + 1) * grid // parts[s], s, k + 1))
    return slots


def exact_parts(weights: dict[str, float]) -> dict[str, int]:
    """Smallest whole numbers in exactly the ratios of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    parts = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*parts.values())
    return {s: n // common for s, n in parts.items()}


def slots_to_end(parts: dict[str, int], blocks: dict[str, int]) -> dict[str, array]:
    """Slots of each source up to the one in which the last source comes to its end."""
    total = sum(parts.values())
    waiting = [(0, s, 0) for s in sorted(parts)]
    ready: list[tuple[int, str, int]] = []
    slots = {s: array("q") for s in parts}
    slot, open_ = 0, len(parts)
    while open_:
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // parts[s]), s, k))
        _, s, k = heapq.heappop(ready)
        slots[s].append(slot)
        open_ -= k + 1 == blocks[s]
        heapq.heappush(waiting, ((k + 1) * total // parts[s], s, k + 1))
        slot += 1
    return slots


def _rows(spark, values: list[dict], schema: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id",
                source_col: str = "source", block_rows: int = BLOCK_ROWS, grid: int = GRID,
                temper: float = TEMPER) -> DataFrame:
    """``docs`` in mixed order: all columns and position, slot, block, epoch.

    ``weights``: target share of each source (null is a source); without them the shares
    are the source sizes to the power ``temper``. Every row is used at least once: the
    mixture ends when the last source has come to its end, and sources that are ahead by
    then start again (``epoch`` 1, 2, ...), so that the shares hold to the end. Rows of
    sources without a positive weight are left out. Inside a source the order is that of
    the hashed id. Sort by ``position`` to read the mixture. Columns of ``docs`` named like
    the four added ones are replaced.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    added = ("position", "slot", "block", "epoch")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), key.alias("_source"),
                       F.col(id_col).alias("_id"), F.xxhash64(id_col).alias("_hash"))
    sizes = {r["_source"]: r["count"] for r in
             rows.groupBy("_source").count().limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        share = {s: n ** temper for s, n in sizes.items()}
    else:
        named = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        share = {s: named[s] for s in sizes if named.get(s, 0) > 0}
    blocks = {s: -(-sizes[s] // block_rows) for s in share}
    exact = exact_parts(share) if share else {}
    slots = period(exact) if sum(exact.values()) <= grid else slots_to_end(exact, blocks)
    # What is laid out: a period, or all slots, which are then not repeated.
    parts = {s: len(own) for s, own in slots.items()}
    grid = sum(parts.values())
    end = max((((n - 1) // parts[s]) * grid + slots[s][(n - 1) % parts[s]] + 1 for s, n in blocks.items()),
              default=0)
    used = {s: (end // grid) * parts[s] + sum(x < end % grid for x in slots[s]) for s in parts} if grid else {}
    plan = _rows(spark, [{"s": s, "part": parts[s], "blocks": blocks[s], "used": used[s]} for s in parts],
                 "s string, part bigint, blocks bigint, used bigint")
    places = _rows(spark, [{"ps": s, "at": i, "own": list(own[i:i + SLOT_ROWS])}
                           for s, own in slots.items() for i in range(0, len(own), SLOT_ROWS)],
                   "ps string, at bigint, own array<bigint>").select(
        "ps", "at", F.posexplode("own").alias("nth", "place")).select(
        "ps", (F.col("at") + F.col("nth")).alias("nth"), "place")

    # The ordinal of a row in its source, in the order of the unsigned hash: numbered in
    # buckets of its first bits, which are even whatever the sizes of the sources, plus the
    # rows in the buckets before.
    bits = max(0, math.ceil(math.log2(max(sum(sizes.values()), 1) / BUCKET_ROWS)))
    bucket = F.shiftrightunsigned("_hash", 64 - bits) if bits else F.lit(0).cast("bigint")
    rows = rows.withColumn("_bucket", bucket)
    counts = rows.groupBy("_source", "_bucket").count()
    before = cut_lineage(counts.select(
        F.col("_source").alias("bs"), F.col("_bucket").alias("bb"),
        F.coalesce(F.sum("count").over(Window.partitionBy("_source").orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    numbered = rows.withColumn("_nth", F.row_number().over(
        Window.partitionBy("_source", "_bucket").orderBy(F.col("_hash").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")), "_id")))
    placed = numbered.join(before, (F.col("_source") == F.col("bs")) & (F.col("_bucket") == F.col("bb"))).withColumn(
        "_at", F.col("_before") + F.col("_nth") - 1)
    # At most MAX_SOURCES rows in the plan; of a table of slots with one row a block the optimiser knows the size.
    places = F.broadcast(places) if grid <= BROADCAST_SLOTS else cut_lineage(places)
    timed = (placed.join(F.broadcast(plan), F.col("_source") == F.col("s"))
             .withColumn("block", F.floor(F.col("_at") / block_rows))
             .withColumn("_turn", F.explode(F.sequence(F.col("block"), F.col("used") - 1, F.col("blocks"))))
             .withColumn("epoch", F.floor(F.col("_turn") / F.col("blocks")))
             .join(places, (F.col("_source") == F.col("ps"))
                   & (F.col("_turn") % F.col("part") == F.col("nth")))
             .withColumn("slot", F.floor(F.col("_turn") / F.col("part")) * grid + F.col("place")))
    return timed.select(*[F.col(f"row.`{c}`") for c in kept],
                        (F.col("slot") * block_rows + F.col("_at") % block_rows).alias("position"), *added[1:])
