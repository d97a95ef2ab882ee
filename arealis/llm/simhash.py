"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints within ``bits`` differences are found through masked bit patterns. The 64
bits are cut into ``bits`` + 2 segments; two such fingerprints agree on two segments at
least, so the upper nodes of the index are the patterns of two segments, and each
fingerprint hangs below one node per pair of segments. Below a node the fingerprints are
sorted by Gray rank, which puts similar ones side by side. Runs of them form the lower
nodes: a node keeps the bits that all its members share, and two nodes are compared by
the differences they have accumulated in shared bits. Beyond ``bits``, both groups are
pruned as a whole; so are groups that are one component already. Every node gives back a
spanning forest of the links it has found, not the links, so a large group of copies
gives one edge per member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from arealis.session import cut_lineage

from .components import components
from .hot import join_counted
from .ship import map_arrow

SHINGLE_WORDS = 4
LINK_BITS = 4
#: Members of an upper node that one task compares; larger nodes are dealt out in blocks.
NODE_BLOCK = 1 << 15
_RUN, _FAN, _CHUNK, _SMALL = 16, 8, 1 << 13, 64


def shingles(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words; the whole sequence if there are fewer words."""
    parts = text.lower().split()  # bytes: A-Z only, and only ASCII white space
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    count = max(n - words + 1, 1)
    pairs = zip(starts[:count].tolist(), ends[min(words, n) - 1:].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in pairs), np.uint64, count)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, distinct: bool = False) -> int:
    """SimHash of a text's shingles, repeats included or not; 0 for a text without words."""
    hashes = shingles(text, words)
    if distinct:
        hashes = np.unique(hashes)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # the bits of a long text are not all unpacked at once
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS, distinct: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words, distinct) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())],
                                             names=["doc_id", "fp"])

    source = docs.select(F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return map_arrow(source, run, T.StructType([source.schema["doc_id"],
                                                T.StructField("fp", T.LongType())]))


def segment_masks(bits: int) -> list[int]:
    """Masks of every pair of the ``bits`` + 2 segments, as signed numbers."""
    edges = [64 * i // (bits + 2) for i in range(bits + 3)]
    segments = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [(m - (1 << 64)) if m >> 63 else m for m in (a | b for a, b in combinations(segments, 2))]


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in the sequence of all Gray codes, as an ordered number."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))


class _Forest:
    """Union-find over positions that keeps the links which joined two components."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Add links, in this order, unless their ends are one component already."""
        open_ = self.root[a] != self.root[b]
        a, b = a[open_], b[open_]
        if not len(a):
            return
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        for x, y, p, q in zip(self.root[a].tolist(), self.root[b].tolist(), a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
                self.links.append((p, q))
        moved = np.arange(len(self.root))
        for x in up:
            moved[x] = find(x)
        self.root = moved[self.root]


def node_forest(fps: np.ndarray, bits: int, split: int | None = None) -> np.ndarray:
    """Links (rows of two positions) that join what all links of at most ``bits`` differences join.

    ``fps``: distinct unsigned fingerprints in Gray order. The closest links come first.
    With ``split`` only links between the first ``split`` and the others are looked for.
    """
    n = len(fps)
    forest = _Forest(n)
    # Levels from the leaves (runs) upwards: bits shared by all members, and their values.
    starts = np.arange(0, n, _RUN)
    both, some = np.bitwise_and.reduceat(fps, starts), np.bitwise_or.reduceat(fps, starts)
    levels = [(both, ~(both ^ some))]
    while len(both) > _FAN:
        starts = np.arange(0, len(both), _FAN)
        both, some = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(some, starts)
        levels.append((both, ~(both ^ some)))
    top = len(levels) - 1
    runs = np.arange(0, n, _RUN)
    for limit in sorted({bits // 2, bits}):
        stack = [(top, *np.triu_indices(len(levels[top][0])))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > _CHUNK:
                stack += [(level, i[c:c + _CHUNK], j[c:c + _CHUNK])
                          for c in reversed(range(0, len(i), _CHUNK))]
                continue
            value, shared = levels[level]
            near = np.bitwise_count((value[i] ^ value[j]) & shared[i] & shared[j]) <= limit
            i, j = i[near], j[near]
            fan = _FAN if level else _RUN
            width = len(levels[level - 1][0]) if level else n
            if not level:  # pairs of runs that are one component already
                low, high = np.minimum.reduceat(forest.root, runs), np.maximum.reduceat(forest.root, runs)
                open_ = (low[i] != high[i]) | (low[j] != high[j]) | (low[i] != low[j])
                i, j = i[open_], j[open_]
            for c in range(0, len(i), 1024):
                a = (i[c:c + 1024, None] * fan + np.arange(fan))[:, :, None]
                b = (j[c:c + 1024, None] * fan + np.arange(fan))[:, None, :]
                a, b = np.broadcast_arrays(a, b)
                fit = (b < width) & ((a <= b) if level else (a < b))
                if not level and split is not None:
                    fit &= (a < split) != (b < split)
                a, b = a[fit], b[fit]
                if level:
                    stack.append((level - 1, a, b))
                    continue
                distance = np.bitwise_count(fps[a] ^ fps[b])
                linked = np.flatnonzero(distance <= limit)
                linked = linked[np.argsort(distance[linked], kind="stable")]
                forest.join(a[linked], b[linked])
    return np.array(forest.links, np.int64).reshape(-1, 2)


def _edges(keys: np.ndarray, sides: np.ndarray, fps: np.ndarray, bits: int) -> pa.RecordBatch:
    """Links within each node; rows are sorted by node, side and Gray rank."""
    n = len(fps)
    bounds = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [n]])
    sizes = np.diff(bounds)
    # Small nodes have one level: all of them at once, each member with the next, the one after ...
    end = np.repeat(np.where(sizes <= _SMALL, bounds[1:], bounds[:-1]), sizes)
    at, pairs = np.arange(n), []
    for k in range(1, _SMALL):
        at = at[at + k < end[at]]
        if not len(at):
            break
        distance = np.bitwise_count(fps[at] ^ fps[at + k])
        linked = (distance <= bits) & ((sides[at] == 2) | (sides[at] != sides[at + k]))
        pairs.append((at[linked], at[linked] + k, distance[linked]))
    found = []
    if pairs:
        a, b, distance = map(np.concatenate, zip(*pairs))
        order = np.argsort(distance, kind="stable")
        forest = _Forest(n)
        forest.join(a[order], b[order])
        found.append(np.array(forest.links, np.int64).reshape(-1, 2))
    for start, stop in zip(bounds[:-1][sizes > _SMALL].tolist(), bounds[1:][sizes > _SMALL].tolist()):
        side = sides[start:stop]
        split = None if side[0] == 2 else int((side == 0).sum())
        if split is None or 0 < split < stop - start:
            found.append(start + node_forest(fps[start:stop], bits, split))
    u, v = fps[np.concatenate(found)].view(np.int64).T if found else np.zeros((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _node_edges(bits: int):
    """For rows (node columns..., side, fp) sorted by node, side and rank: links of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows of the node that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64)
                             for c in batch.columns[:-2]], axis=1)
            sides = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            fps = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64)
            if rest and (rest[-1][0][-1] != keys[0]).any():
                yield _edges(*map(np.concatenate, zip(*rest)), bits)
                rest = []
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            if len(last):
                cut = int(last[-1]) + 1
                rest.append((keys[:cut], sides[:cut], fps[:cut]))
                yield _edges(*map(np.concatenate, zip(*rest)), bits)
                rest = [(keys[cut:], sides[cut:], fps[cut:])]
            else:
                rest.append((keys, sides, fps))
        if rest:
            yield _edges(*map(np.concatenate, zip(*rest)), bits)

    return run


def near_links(fps: DataFrame, bits: int = LINK_BITS, block: int = NODE_BLOCK) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fps`` (column fp) with the components
    of all links of at most ``bits`` differences."""
    masks = segment_masks(bits)
    nodes = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("value"))
        for i, m in enumerate(masks)])).alias("node")).select("fp", "node.mask", "node.value")
    sizes = nodes.groupBy("mask", "value").agg(F.count("*").alias("n"))
    large = cut_lineage(sizes.filter(F.col("n") > block)
                        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    schema = "u bigint, v bigint"
    run = _node_edges(bits)
    if large.isEmpty():
        return map_arrow(
            nodes.repartition("mask", "value").sortWithinPartitions("mask", "value", gray_rank(F.col("fp")))
            .select("mask", "value", F.lit(2).alias("side"), "fp"), run, schema)
    small = nodes.join(large, ["mask", "value"], "left_anti").select(
        "mask", "value", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"), "fp")
    # A large node: every pair of its blocks is a task of its own.
    placed = join_counted(cut_lineage(nodes.join(large.select("mask", "value"), ["mask", "value"], "left_semi")),
                          large, ["mask", "value"], "n").withColumn(
        "at", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = placed.select("mask", "value", "fp", "at", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "mask", "value", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
        F.when(F.col("at") == F.col("other"), 2).when(F.col("at") < F.col("other"), 0)
        .otherwise(1).alias("side"), "fp")
    rows = small.unionByName(dealt)
    return map_arrow(
        rows.repartition("mask", "value", "i", "j")
        .sortWithinPartitions("mask", "value", "i", "j", "side", gray_rank(F.col("fp"))), run, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, bits: int = LINK_BITS, distinct: bool = False,
                    block: int = NODE_BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most ``bits`` bits are linked;
    ``component_id`` is the smallest id in reach. A null or empty text has fingerprint
    zero. Rows with a null id are linked too, but a null id is no component id unless
    nothing else is in reach. Rows that repeat an id are separate documents.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, words, distinct))
    firsts = cut_lineage(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")))
    links = near_links(firsts.select("fp"), bits, block)
    roots = components(links)
    linked = cut_lineage(firsts.join(roots.withColumnRenamed("v", "fp"), "fp", "left")
                         .withColumn("root", F.coalesce("root", "fp")))
    least = cut_lineage(linked.groupBy("root").agg(
        F.count("*").alias("m"), F.min("first").alias("component_id")))
    table = cut_lineage(join_counted(linked, least, ["root"], "m").select("fp", "n", "component_id"))
    return join_counted(rows, table, ["fp"], "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
