"""Near duplicates by HyperMinHash registers, banding and verification on the full sets.

A document is its set of distinct shingles. The hash of a shingle names one of REGISTERS
buckets; of the smallest remaining bits in a bucket, the register stores the number of
leading zeros and MANTISSA bits after the first one, two bytes in all. An empty bucket
takes over the register of the first filled bucket in a fixed order of its own, so that
small sets fill all registers, too, and each register of two sets is equal with the
probability of their similarity.

Bands of BAND_ROWS registers bring sets together. For two sets of similarity 0.8 a band is
equal with probability 0.8^BAND_ROWS; that none of the bands is equal has a chance of
about 2e-9. A set is first compared with one other, the smallest that it shares a bucket
with. Buckets whose sets are one component by then are done. Of all others, sets of
different components are compared inside tasks, in blocks, so that no pair becomes a row:
the similarity of two sets is estimated from their registers, corrected for registers
that are equal by collision, and sets with a partner that comes within MARGIN of the limit
go on; these meet once more in their bucket with their full sets, and the links that are
confirmed there come back as a spanning forest. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from arealis.session import cut_lineage

from .components import components
from .hot import join_counted, join_hashed
from .ship import map_arrow, small_batches
from .words import GROUP_BYTES, row_groups, split_words

REGISTERS, MANTISSA, BAND_ROWS = 256, 10, 5  # a band is compared as four registers and one
BANDS = REGISTERS // BAND_ROWS
#: The standard deviation of an estimate at 0.8 is 0.03 at most; pairs are verified from six of them below on.
MARGIN = 0.2
#: Sets of a bucket that one task compares with as many others; larger buckets are dealt out in pairs of blocks.
BLOCK = 1 << 10
#: Links that a task writes in a round of the components: fewer tasks where there are few links.
PART = 1 << 15
_VALUE_BITS = 53
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Per text the hashes of its distinct shingles, ascending: of ``words`` lower-cased words
    (A-Z only) each, of the whole sequence if there are fewer, none without words."""
    parts, offsets = split_words(pc.ascii_lower(texts))
    coded = parts.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in coded.dictionary), np.uint64,
                        len(coded.dictionary))
    own = known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)
    made = _mix(own + _GOLD)
    for k in range(1, words):
        made = _mix(made[:-1] * _GOLD + own[k:])
    out = []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if stop - start >= words:
            out.append(np.unique(made[start:stop - words + 1]))
        elif stop > start:
            whole = _mix(own[start:start + 1] + _GOLD)
            for k in range(start + 1, stop):
                whole = _mix(whole * _GOLD + own[k:k + 1])
            out.append(_mix(whole ^ np.uint64(stop - start)))  # not a shingle of a longer text
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


_places = np.argsort(np.random.default_rng(7).random((REGISTERS, REGISTERS)), axis=1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of REGISTERS two-byte registers for each set; zeros for an empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    hashes = _mix(np.concatenate([*sets, np.zeros(0, np.uint64)]) + np.uint64(1))
    slot = np.repeat(np.arange(len(sets)) * REGISTERS, sizes) + (hashes & np.uint64(REGISTERS - 1)).astype(np.int64)
    low = np.full(len(sets) * REGISTERS, np.uint64(1) << np.uint64(_VALUE_BITS))
    np.minimum.at(low, slot, hashes >> np.uint64(64 - _VALUE_BITS))
    filled = (low >> np.uint64(_VALUE_BITS) == 0).reshape(-1, REGISTERS)
    bits = low.astype(np.float64).view(np.uint64)  # exponent and mantissa of a whole number
    zeros = np.uint64(_VALUE_BITS + 1023 - 1) - np.maximum(bits >> np.uint64(52), np.uint64(1022))
    codes = ((zeros << np.uint64(MANTISSA)) | ((bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)))
    codes = codes.astype(np.uint16).reshape(-1, REGISTERS)
    codes[~filled] = 0
    row, gap = np.nonzero(~filled & (sizes > 0)[:, None])
    for turn in range(REGISTERS):
        if not len(row):
            break
        source = _places[gap, turn]
        hit = filled[row, source]
        codes[row[hit], gap[hit]] = codes[row[hit], source[hit]]
        row, gap = row[~hit], gap[~hit]
    return codes


def value_chances(n: np.ndarray) -> np.ndarray:
    """For sets of sizes ``n``, a row each: by number of leading zeros, the probability of a register,
    scaled so that the sum of products of two rows is the chance that two unlike sets agree."""
    low = 2.0 ** -np.arange(1, _VALUE_BITS + 1)
    load = np.maximum(n / REGISTERS, 1.0)[:, None]
    return (np.exp(-load * low) - np.exp(-load * 2 * low)) / 2.0 ** (MANTISSA / 2)


def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that the registers of a bucket of two sets without a common element are equal."""
    return (value_chances(n) * value_chances(m)).sum(axis=1)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sets from their registers (rows of ``a`` and ``b``) and sizes."""
    by_chance = chance_equal(n, m)
    return ((a == b).mean(axis=1) - by_chance) / (1 - by_chance)


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in row_groups(batch.column(2)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                sets = shingle_sets(part.column(2), words)
                codes = registers(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_name(s) for s in sets], pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary())], names=["doc_id", "th", "n", "sid", "regs"])
    return run


def _likely(least: float):
    """For rows (u, v, n_u, n_v, regs_u, regs_v): the pairs whose estimate comes near the limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = estimate(_rows(batch.column(4)), _rows(batch.column(5)), batch.column(2).to_numpy(),
                                batch.column(3).to_numpy()) >= least - MARGIN
                yield batch.select(["u", "v"]).filter(pa.array(near))
    return run


def _bits(named: DataFrame) -> np.ndarray:
    """A bit for each value of ``own`` modulo their number (a power of two): 16 or more per value, 2^25 at most."""
    size = 1 << min(max((16 * named.count()).bit_length(), 10), 25)
    at = F.col("own").bitwiseAND(F.lit(size - 1))
    found = named.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    bits = np.zeros(size >> 6, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def _pack(bits: np.ndarray):
    """For rows (th, doc_id, text) with the bit of ``th`` set: the text compressed, as the codec of
    the shuffle gains little on prose. The others stay out of the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & np.uint64(64 * len(bits) - 1)
            kept = batch.filter(pa.array((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1))
            packed = [press.compress(t.as_buffer()) if t.is_valid else None for t in kept.column(2)]
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(packed, pa.binary())],
                                             names=["th", "doc_id", "packed"])
    return run


def _full_sets(words: int):
    """For rows (no, sid, packed): the set of the text, if it has this name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in row_groups(batch.column(2), GROUP_BYTES // 4):
                packed = batch.column(2)[rows]
                texts = pa.array([zstandard.ZstdDecompressor().decompress(t.as_py()).decode() for t in packed], pa.string())
                sets = shingle_sets(texts, words)
                same = [set_name(s) == sid.as_py() for s, sid in zip(sets, batch.column(1)[rows])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["no", "hashes"]).filter(pa.array(same, pa.bool_()))
    return run


def _alike(least: Fraction):
    """For rows (u, v, hashes_u, hashes_v): the pairs whose sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                found.append(shared * least.denominator >= (len(a) + len(b) - shared) * least.numerator)
            yield batch.select(["u", "v"]).filter(pa.array(found, pa.bool_()))
    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by (key, i, j, side), many at a time, and the bounds of the groups."""
    def bounds(table: pa.Table) -> np.ndarray:
        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in range(3)])
        return np.concatenate([[0], np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1, [table.num_rows]])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([*held, batch])
            cuts = bounds(table)
            last = int(cuts[-2])
            if last:
                yield table.slice(0, last), cuts[:-1]
            held = table.slice(last).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _pairs(sides: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within groups, each time of many rows with one other each; of dealt-out
    groups (sides 0 and 1) those across the sides."""
    n = len(sides)
    end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero((sides == 2) & (np.arange(n) + 1 < end))
    k = 1
    while len(at):
        yield at, at + k
        k += 1
        at = at[at + k < end[at]]
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if sides[start] != 2:
            middle = start + int(np.searchsorted(sides[start:stop], 1))
            other = np.arange(middle, stop)
            for row in range(start, middle):
                yield np.full(len(other), row), other


def _with_partner(least: Fraction):
    """For rows (key, i, j, side, band, no, n, root, regs) sorted by group: those that may be similar
    to a set of another component, judged by sizes and registers.

    A pair is judged in the first band that it shares.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches):
            sides, band, n, root = (table.column(c).to_numpy() for c in (3, 4, 6, 7))
            codes = _rows(table.column(8))
            keep = np.zeros(len(sides), bool)
            bands = codes[:, :BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS)
            front = np.ascontiguousarray(bands[:, :, :4]).view(np.uint64)[:, :, 0]  # four registers at once
            back = np.ascontiguousarray(bands[:, :, 4:]).view(np.uint16)[:, :, 0]
            limit = float(least) - MARGIN
            sizes, size = np.unique(n, return_inverse=True)
            chances = value_chances(sizes)
            for a, b in _pairs(sides, bounds):
                open_ = (root[a] != root[b]) & ~(keep[a] & keep[b]) & (
                    np.minimum(n[a], n[b]) * least.denominator >= np.maximum(n[a], n[b]) * least.numerator)
                a, b = a[open_], b[open_]
                for cut in range(0, len(a), 1 << 12):
                    x, y = a[cut:cut + (1 << 12)], b[cut:cut + (1 << 12)]
                    share = np.bitwise_count((codes[x] == codes[y]).view(np.uint64)).sum(axis=1) / REGISTERS
                    # The correction lowers a share by no more than 2^-MANTISSA: few pairs need it.
                    near = np.flatnonzero(share >= limit)
                    first = ((front[x[near]] == front[y[near]]) & (back[x[near]] == back[y[near]])).argmax(axis=1)
                    near = near[first == band[x[near]]]
                    edge = near[share[near] < limit + 2 / REGISTERS]
                    by_chance = (chances[size[x[edge]]] * chances[size[y[edge]]]).sum(axis=1)
                    low = edge[(share[edge] - by_chance) / (1 - by_chance) < limit]
                    near = np.setdiff1d(near, low)
                    keep[x[near]] = keep[y[near]] = True
            yield from table.select(["key", "i", "j", "side", "no", "root"]).filter(pa.array(keep)).to_batches()
    return run


def _confirmed(least: Fraction):
    """For rows (key, i, j, side, no, root, hashes) sorted by group: a spanning forest of the links
    between similar full sets of different components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches):
            sides, no, root = (table.column(c).to_numpy() for c in (3, 4, 5))
            hashes = [np.frombuffer(s.as_buffer(), np.uint64) for chunk in table.column(6).chunks for s in chunk]
            u, v = [], []
            for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                sizes = np.fromiter(map(len, hashes[start:stop]), np.int64, stop - start)
                known, codes = np.unique(np.concatenate(hashes[start:stop]), return_inverse=True)
                starts = np.cumsum(sizes) - sizes
                own = root[start:stop].copy()  # smallest root of the component so far
                side, flag = sides[start:stop], np.zeros(len(known), bool)
                for a in range(stop - start):
                    wanted = (own != own[a]) & ((side != side[a]) | (side == 2)) & (
                        np.minimum(sizes, sizes[a]) * least.denominator >= np.maximum(sizes, sizes[a]) * least.numerator)
                    if not wanted.any():
                        continue
                    part = codes[starts[a]:starts[a] + sizes[a]]
                    flag[part] = True
                    shared = np.add.reduceat(flag[codes], starts, dtype=np.int64)
                    flag[part] = False
                    alike = shared * least.denominator >= (sizes + sizes[a] - shared) * least.numerator
                    for b in np.flatnonzero(wanted & alike).tolist():
                        if own[a] != own[b]:
                            u.append(no[start + a])
                            v.append(no[start + b])
                            own[(own == own[a]) | (own == own[b])] = min(own[a], own[b])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def _texts_of(wanted: DataFrame, sets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(no, hashes): the full sets of the numbers in ``wanted``, from one text of each."""
    named = cut_lineage(sets.join(wanted.select("no").distinct(), "no", "left_semi").select(
        "no", "sid", F.col("th").alias("own"), "doc"))
    packed = map_arrow(texts, _pack(_bits(named)), T.StructType([
        T.StructField("th", T.LongType()), texts.schema["doc_id"], T.StructField("packed", T.BinaryType())]))
    own = packed.join(named, (F.col("th") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("doc")))
    # The one text of each set may come in several equal rows.
    return cut_lineage(map_arrow(own.select("no", "sid", "packed"), _full_sets(words), "no bigint, hashes binary")
                       .dropDuplicates(["no"]))


def _sides(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (u, v) with columns of both."""
    for end in ("u", "v"):
        pairs = pairs.join(of.select(F.col("no").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return pairs.select("u", "v", *[f"{c}_{end}" for c in columns for end in ("u", "v")])


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """(key, i, j, side, band, no, n, root, ``columns``): ``rows`` with ``places`` in the groups of their buckets.

    A small bucket is one group (side 2: all its pairs). The sets of a large one are dealt to
    blocks, those of its main component to blocks of their own, after the others. Every block
    of the others is a group by itself and one with each block that follows: a pair meets once.
    """
    struct = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    part = lambda n: F.pmod(F.xxhash64("no"), n).cast("int")
    zero, one, two = F.lit(0), F.lit(1), F.lit(2)
    blocks, mains = F.col("place.blocks"), F.col("place.mains")
    own, last = part(blocks), blocks + part(mains)
    slots = F.when(blocks.isNull(), F.array(struct(zero, zero, two))).when(
        F.col("root") != F.col("place.main"), F.transform(F.sequence(zero, blocks + mains - 1), lambda x: struct(
            F.least(x, own), F.greatest(x, own), F.when(x == own, two).when(x > own, zero).otherwise(one)))
    ).otherwise(F.transform(F.sequence(zero, blocks - 1), lambda x: struct(x, last, one)))
    single = rows.select("no", "n", "root", *columns, F.explode("places").alias("place"))
    return single.withColumn("at", F.explode(slots)).select(
        "place.key", "at.*", "place.band", "no", "n", "root", *columns)


def set_roots(sets: DataFrame, texts: DataFrame, words: int, least: Fraction, block: int = BLOCK) -> DataFrame:
    """(no, root) of ``sets`` (no, n, sid, th, doc, regs) that are similar to another one: their components."""
    bands = F.array(*[F.struct(F.xxhash64(F.substring("regs", 2 * BAND_ROWS * i + 1, 2 * BAND_ROWS), F.lit(i)).alias("key"),
                               F.lit(i).alias("band")) for i in range(BANDS)])
    keyed = sets.select("no", "n", F.explode(bands).alias("b")).select("no", "n", "b.key", "b.band")
    shared = cut_lineage(keyed.groupBy("key").agg(F.count("*").alias("m"), F.min(F.struct("no", "n")).alias("lead"))
                         .filter("m > 1"))
    members = cut_lineage(join_hashed(keyed, shared, "key", "m"))

    first = members.filter(F.col("no") != F.col("lead.no")).groupBy("no", "n").agg(F.min("lead").alias("lead"))
    fit = F.least("n", "lead.n") * least.denominator >= F.greatest("n", "lead.n") * least.numerator
    pairs = first.filter(fit).select(F.col("lead.no").alias("u"), F.col("no").alias("v"))
    likely = cut_lineage(map_arrow(_sides(pairs, sets, "n", "regs"), _likely(float(least)), "u bigint, v bigint"))
    full = _texts_of(likely.select(F.explode(F.array("u", "v")).alias("no")), sets, texts, words)
    links = cut_lineage(map_arrow(_sides(likely, full, "hashes"), _alike(least), "u bigint, v bigint"))

    roots = cut_lineage(components(links, PART).withColumnRenamed("v", "no"))
    placed = cut_lineage(members.drop("lead").join(roots, "no", "left").withColumn("root", F.coalesce("root", "no")))
    # Only pairs across components are open, and each has an end outside the bucket's largest one.
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("s")).groupBy("key").agg(
        F.sum("s").alias("m"), F.max("s").alias("most"), F.max_by("root", F.struct("s", "root")).alias("main"))
    large = lambda n: F.when(F.col("m") > block, F.ceil(n / block)).cast("int")
    left = cut_lineage(sizes.filter("most < m").select(
        "key", "m", "main", large(F.col("m") - F.col("most")).alias("blocks"), large(F.col("most")).alias("mains")))
    # A set meets its registers, and its full set, once; only then it is dealt out to its groups.
    places = join_hashed(placed, left, "key", "m").groupBy("no", "n", "root").agg(
        F.collect_list(F.struct("key", "band", "main", "blocks", "mains")).alias("places"))
    group = ["key", "i", "j"]
    rows = _dealt(places.join(sets.select("no", "regs"), "no"), "regs")
    near = cut_lineage(map_arrow(rows.repartition(*group).sortWithinPartitions(*group, "side"), _with_partner(least),
                                 "key bigint, i int, j int, side int, no bigint, root bigint"))
    full = _texts_of(near, sets, texts, words)
    rows = near.groupBy("no", "root").agg(F.collect_list(F.struct(*group, "side")).alias("at")).join(full, "no").select(
        F.explode("at").alias("at"), "no", "root", "hashes").select("at.*", "no", "root", "hashes")
    found = map_arrow(rows.repartition(*group).sortWithinPartitions(*group, "side"), _confirmed(least), "u bigint, v bigint")
    return cut_lineage(components(links.unionByName(found), PART).withColumnRenamed("v", "no"))


def near_duplicate_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 2,
                        similarity: float | str = "0.8", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents whose sets of distinct shingles of ``words`` lower-cased words have a
    similarity (Jaccard) of at least ``similarity`` are linked; ``component_id`` is the
    smallest id in reach, ``kept`` tells whether it is the row's own. Fewer words are one
    shingle. A null, empty or blank text has no shingle and is linked with nothing. Rows
    that repeat an id are separate documents. A row with a null id links others like any
    row, but is no component id; its ``component_id`` is null if no row with an id is in
    reach, and ``kept`` is false.
    """
    least = Fraction(str(similarity))
    if not Fraction(4, 5) <= least <= 1:
        raise ValueError("the bands are made for similarities from 0.8 to 1")
    with small_batches(docs.sparkSession):
        text = F.col(text_col).cast("string")
        source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
        rows = cut_lineage(map_arrow(source, _sketch(words), T.StructType([
            source.schema["doc_id"], T.StructField("th", T.LongType()), T.StructField("n", T.LongType()),
            T.StructField("sid", T.BinaryType()), T.StructField("regs", T.BinaryType())])))
        named = cut_lineage(rows.filter("n > 0").groupBy("sid").agg(
            F.count("*").alias("m"), F.min("doc_id").alias("first"), F.max("n").alias("n"),
            F.min(F.struct("th", F.col("doc_id").alias("doc"), "regs")).alias("one"))
            .select("sid", "m", "first", "n", "one.*").withColumn("no", F.monotonically_increasing_id()))
        roots = set_roots(named.drop("m", "first"), source.select("th", "doc_id", "text"), words, least, block)
    linked = cut_lineage(named.select("sid", "m", "first", "no").join(roots, "no", "left").withColumn(
        "root", F.coalesce("root", "no")))
    ids = cut_lineage(linked.groupBy("root").agg(F.count("*").alias("k"), F.min("first").alias("component_id")))
    table = cut_lineage(join_counted(linked, ids, ["root"], "k").select("sid", "m", "component_id"))
    placed = join_counted(rows.filter("n > 0").select("doc_id", "n", "sid"), table, ["sid"], "m").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
