"""URL rules by cascades of Bloom filters.

The keys of a URL are all its host's suffixes with all its path's prefixes that could be
a rule. The keys of all URLs are the universe, and it is known completely: level 1 of a
cascade encodes the listed keys, level 2 the other keys of the universe that level 1
lets through by mistake, level 3 the listed keys that level 2 lets through, and so on
until a level makes no mistake. Within the universe a lookup is exact, without a join and
without the list: a few bits per listed key, whatever the number of URLs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arealis.session import cut_lineage

from .ship import map_arrow

#: Bits of one level that are sent to every task. Longer lists are split by hash into parts
#: of this size, and the keys go through the parts one after the other.
MAX_LEVEL_BITS = 1 << 29
MAX_LEVELS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def candidate_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Keys of a URL, longest first (of equal length: longer host first), as structs with
    the key and two independent hashes. ``lengths``: lengths that the rules' paths have."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                     lambda p: p.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(paths, lambda p: F.struct(
        (-(F.length(s) + F.length(p))).alias("order"), (-F.length(s)).alias("host"),
        F.concat(s, p).alias("key")))))
    return F.transform(F.array_sort(keys), lambda k: F.struct(
        k["key"].alias("key"), F.xxhash64(k["key"]).alias("h1"), F.xxhash64(F.lit(1), k["key"]).alias("h2")))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bit positions (key x hash) of keys in a level."""
    start = _mix(h1.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    step = _mix(h2.view(np.uint64) ^ np.uint64(level)) | np.uint64(1)
    turns = start[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)
    return (turns % np.uint64(bits)).astype(np.int64)


class Cascade:
    """Levels of Bloom filters, each (hashes, bits, words)."""

    def __init__(self):
        self.levels: list[tuple[int, int, np.ndarray]] = []

    @property
    def n_bytes(self) -> int:
        return sum(words.nbytes for _, _, words in self.levels)

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        hashes, bits, words = self.levels[level]
        at = _places(h1, h2, level, hashes, bits)
        return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe."""
        listed = np.zeros(len(h1), bool)
        live = np.arange(len(h1))
        for level in range(len(self.levels)):
            inside = self.passes(level, h1[live], h2[live])
            listed[live[~inside]] = level % 2 == 1
            live = live[inside]
        listed[live] = len(self.levels) % 2 == 1
        return listed


def _sized(n: int, rate: float) -> tuple[int, int]:
    """Hashes and bits of a filter of n keys with this false positive rate."""
    bits = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
    return max(1, round(bits / max(n, 1) * math.log(2))), bits


def _filled(keys: DataFrame, level: int, hashes: int, bits: int) -> np.ndarray:
    """The words of a filter with all ``keys`` (h1, h2). Bits are combined before and after
    the shuffle; what reaches the driver has the size of the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy(), batch.column(1).to_numpy(), level, hashes, bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((at & 63).astype(np.int32))],
                                             names=["word", "bit"])

    set_bits = map_arrow(keys.select("h1", "h2"), run, "word bigint, bit int")
    found = set_bits.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask")).toArrow()
    words = np.zeros(-(-bits // 64), np.int64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy()
    return words.view(np.uint64)


def _through(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    """The ``keys`` that a level lets through, as a written table."""
    shared = keys.sparkSession.sparkContext.broadcast(cascade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = shared.value.passes(level, batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield batch.filter(pa.array(inside))

    return cut_lineage(map_arrow(keys.select("h1", "h2"), run, "h1 bigint, h2 bigint"))


def build_cascade(listed: DataFrame, others: DataFrame) -> Cascade:
    """Cascade that holds ``listed`` and none of ``others``; both distinct, with h1 and h2."""
    cascade = Cascade()
    inside, outside = listed, others
    n_in, n_out = inside.count(), outside.count()
    while n_in and len(cascade.levels) < MAX_LEVELS:
        # The first level leaves about as many mistakes as there are listed keys.
        first = not cascade.levels
        rate = min(0.5, max(n_in * math.sqrt(0.5) / max(n_out, 1), 1e-9)) if first else 0.5
        hashes, bits = _sized(n_in, rate)
        cascade.levels.append((hashes, bits, _filled(inside, len(cascade.levels), hashes, bits)))
        wrong = _through(outside, cascade, len(cascade.levels) - 1)
        inside, outside = wrong, inside
        n_in, n_out = wrong.count(), n_in
    if n_in:
        raise ValueError("a listed key and another share both hashes")
    return cascade


def build_cascades(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_LEVEL_BITS) -> list[Cascade]:
    """One cascade, or several by the hash of the key if one would have too many bits.

    ``universe``: all distinct keys (h1, h2); ``listed``: a part of it, distinct too.
    """
    n, total = listed.count(), universe.count()
    parts = -(-_sized(n, min(0.5, max(n * 0.7 / max(total, 1), 1e-9)))[1] // max_bits)
    others = universe.join(listed, ["h1", "h2"], "left_anti")
    own = lambda df, i: df.filter(F.pmod("h1", F.lit(parts)) == i) if parts > 1 else df
    return [build_cascade(own(listed, i), own(others, i)) for i in range(parts)]


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", max_bits: int = MAX_LEVEL_BITS) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    ``rules``: host, path, verdict (``block`` or ``allow``; one row per host and path). A
    rule fits its host and all subdomains if the path starts with the rule's; the longest
    rule wins, of equally long ones that with the longer host. Where none fits, ``rule``
    is null and the verdict is ``default``: the cascades say that no key is listed.
    """
    spark = pages.sparkSession
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").distinct()
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect()) or [0]
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    keyed = split.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    universe = cut_lineage(keyed.select(F.explode("keys").alias("k")).select("k.h1", "k.h2").distinct())
    hashed = rules.withColumn("key", F.concat("host", "path")).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "verdict")
    cascades = {v: build_cascades(cut_lineage(hashed.filter(F.col("verdict") == v).select("h1", "h2")
                                              .join(universe, ["h1", "h2"], "left_semi")), universe, max_bits)
                for v in ("block", "allow")}
    rows = keyed.withColumn("rule", F.lit(None).cast("string")).withColumn(
        "found", F.lit(None).cast("string")).withColumn("at", F.lit(1 << 30))
    names = rows.columns
    for verdict, parts in cascades.items():
        for i, cascade in enumerate(parts):
            if cascade.levels:
                rows = _marked(rows, spark.sparkContext.broadcast(cascade), verdict, i, len(parts))
    return rows.select(*[f"`{c}`" for c in names[:3]], "rule", F.coalesce("found", F.lit(default)).alias("verdict"))


def _marked(rows: DataFrame, shared, verdict: str, part: int, parts: int) -> DataFrame:
    """Rows with ``rule``, ``found`` and ``at`` set where a key that stands earlier is in the cascade."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3)
            flat = keys.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(keys.offsets.to_numpy()))
            place = np.arange(len(flat)) - (keys.offsets.to_numpy()[:-1] - keys.offsets[0].as_py())[owner]
            h1, h2 = flat.field(1).to_numpy(), flat.field(2).to_numpy()
            listed = shared.value.contains(h1, h2)
            if parts > 1:
                listed &= np.mod(h1, parts) == part
            at = batch.column(6).to_numpy().copy()
            hit = np.flatnonzero(listed)[::-1]  # backwards: the first key of a row is set last
            hit = hit[place[hit] < at[owner[hit]]]
            chosen = np.full(batch.num_rows, -1)
            chosen[owner[hit]] = hit
            moved = chosen >= 0
            at[moved] = place[chosen[moved]]
            rule, found = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for row in np.flatnonzero(moved).tolist():
                rule[row], found[row] = flat.field(0)[int(chosen[row])].as_py(), verdict
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(rule, pa.string()), pa.array(found, pa.string()), pa.array(at)],
                names=batch.schema.names)

    return map_arrow(rows, run, rows.schema)
