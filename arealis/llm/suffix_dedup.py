"""Removal of repeated passages with suffix arrays built by two-stage sorting.

Equal passages of ``length`` bytes are brought together by content: the k-gram with the
smallest hash inside a passage is its anchor, and equal passages have equal anchors. Only
anchors that several documents share go on; around each of them the bytes of every
passage that contains it are cut out (the context), and contexts with the same anchor meet
in one task. There a suffix array is built of the distinct contexts that can share a passage
with another one: suffixes smaller than their successors are sorted directly, all others are
induced by scanning the buckets of first bytes once. Neighbours in the array that share ``length`` bytes are
equal passages; the smallest document of each run keeps its copy.

Documents that equal an earlier one as a whole are found first and take no part.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from arealis.session import cut_lineage

from .hot import join_counted
from .ship import map_arrow

LENGTH = 50
GRAM = 16
GROUP_BYTES = 1 << 18
#: Contexts that one suffix array holds at least, if there are as many; whole keys only.
ARRAY_CONTEXTS = 1 << 14
#: Contexts that are held to find equal ones before they go to the shuffle.
BATCH_CONTEXTS = 1 << 17
_POS_BITS = 40


# ---------------------------------------------------------------- suffix array


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number; zeros follow the end."""
    out = np.concatenate([text, np.zeros(7, np.uint8)])
    for bits in (8, 16, 32):
        wide = out.astype(f"u{bits // 4}")
        out = (wide[:-(bits // 8)] << wide.dtype.type(bits)) | wide[bits // 8:]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (uint8) in the order of at least the first ``depth`` bytes from there."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    # A suffix is smaller than its successor if the next different byte is larger.
    step = np.sign(np.diff(text.astype(np.int16)))
    decided = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    smaller = np.append(np.append(step, -1)[following] > 0, False)

    # First stage: sort these suffixes, eight bytes at a time; only ties go on.
    words = _words(text)
    last = np.uint64(0)
    rank = np.flatnonzero(smaller)
    rank = rank[np.argsort(words[rank], kind="stable")]
    tied = np.zeros(len(rank), bool)
    if len(rank) > 1:
        same = words[rank][1:] == words[rank][:-1]
        tied[1:] |= same
        tied[:-1] |= same
    group = np.cumsum(np.concatenate([[0], words[rank][1:] != words[rank][:-1]])) if len(rank) else rank
    for offset in range(8, depth + 8, 8):
        at = np.flatnonzero(tied)
        if not len(at):
            break
        suffix = rank[at] + offset
        word = np.where(suffix < n, words[np.minimum(suffix, n - 1)], last)
        order = np.lexsort((word, group[at]))
        rank[at] = rank[at][order]
        word, own = word[order], group[at]  # the groups stay where they are
        new = np.concatenate([[True], (word[1:] != word[:-1]) | (own[1:] != own[:-1])])
        group[at] = np.cumsum(new) - 1
        same = np.concatenate([~new[1:], [False]]) | ~new
        tied[at] = same

    # Second stage: one scan of the buckets; each suffix places the one before it.
    direct = np.split(rank, np.searchsorted(text[rank], np.arange(1, 256)))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[-1]].append(np.array([n - 1]))
    out = []

    def place(found: np.ndarray, bucket: int) -> np.ndarray:
        """Hand out the larger predecessors of ``found``; gives back those of this bucket."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        letters = text[before]
        own = before[letters == bucket]
        rest, letters = before[letters != bucket], letters[letters != bucket]
        order = np.argsort(letters, kind="stable")
        rest, letters = rest[order], letters[order]
        cuts = np.flatnonzero(np.diff(letters)) + 1
        for part in np.split(rest, cuts):
            if len(part):
                induced[text[part[0]]].append(part)
        return own

    for bucket in range(256):
        found = np.concatenate(induced[bucket]) if induced[bucket] else np.zeros(0, np.int64)
        while len(found):
            out.append(found)
            found = place(found, bucket)
        out.append(direct[bucket])
        place(direct[bucket], bucket)
    return np.concatenate(out)


def passage_groups(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each passage of ``length`` bytes within a context: context, offset and number of its class.

    Equal passages have the same number. The common prefix of neighbours in the suffix
    array is compared up to ``length`` bytes.
    """
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    text = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(len(text)) - starts[owner]
    order = suffix_array(text, length)
    order = order[offset[order] + length <= sizes[owner[order]]]
    words = _words(text)
    equal = np.ones(max(len(order) - 1, 0), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        word = words[order + k]
        equal &= word[1:] == word[:-1]
    number = np.cumsum(np.concatenate([np.zeros(min(1, len(order)), int), ~equal]))
    return owner[order], offset[order], number


# ---------------------------------------------------------------- anchors


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _low(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:len(values) - done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    words = _words(text)
    count = max(len(text) - GRAM + 1, 0)
    return _mix(words[:count] * np.uint64(0x9E3779B97F4A7C15) ^ _mix(words[8:8 + count]))


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of the anchors of all passages of ``length`` bytes."""
    window = length - GRAM + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(texts), np.uint8)
    grams = gram_hashes(text)
    if len(grams) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    least = _low(grams, window)
    whole = np.zeros(len(least) + 1, np.int64)  # +1 where the passages of a text begin, -1 where they end
    long = sizes >= length
    np.add.at(whole, starts[long], 1)
    np.add.at(whole, starts[long] + sizes[long] - length + 1, -1)
    inside = np.cumsum(whole)[:len(least)] > 0
    # A gram is an anchor if it is the least of any passage around it.
    shown = np.where(inside, least, 0)
    edge = np.zeros(window - 1, np.uint64)
    most = ~_low(~np.concatenate([edge, shown, edge]), window)
    at = np.flatnonzero(most[:len(grams)] == grams)
    owner = np.searchsorted(starts, at, side="right") - 1
    # Empty texts share their start with the next one; searchsorted gives the last of them.
    return owner, at - starts[owner], grams[at]


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    held, size, first = [], 0, 0
    for row, value in enumerate(batch.column(column)):
        held.append(value.as_py())
        size += len(held[-1])
        if size >= GROUP_BYTES:
            yield first, held
            held, size, first = [], 0, row + 1
    if held:
        yield first, held


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, texts in _groups(batch, 2):
                owner, at, key = anchors(texts, length)
                owner = owner + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(docs[owner]),
                     pa.array((tags[owner] << _POS_BITS) | at)], names=["key", "doc", "ref"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key is in several documents."""
    held: list[pa.RecordBatch] = []  # rows of the last key while it has one document only
    key = doc = None
    shared = False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, docs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(bounds[1:], len(keys))
        several = np.minimum.reduceat(docs, bounds) != np.maximum.reduceat(docs, bounds)
        if keys[0] == key:
            several[0] |= shared or doc != docs[0]
            if several[0]:
                yield from held
                held = []
        else:
            held = []
        keep = np.repeat(several, ends - bounds)
        if keep.any():
            yield batch.filter(pa.array(keep))
        if keys[-1] != key or len(bounds) > 1:
            held = []
        key, doc, shared = keys[-1], docs[-1], bool(several[-1])
        if not shared:
            held.append(batch.slice(int(bounds[-1])))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows (doc, tag, text): the text compressed for the shuffle, whose own codec gains little on prose."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [press.compress(t.as_buffer()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                                         names=["doc", "tag", "packed"])


def _cut_contexts(length: int):
    """For rows (doc, tag, packed, refs, keys): each context once per batch, with its documents."""
    open_ = zstandard.ZstdDecompressor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, bytes], int] = {}
            code, docs, places = [], [], []
            for doc, packed, refs, keys in zip(*(batch.column(c) for c in (0, 2, 3, 4))):
                text, ref = open_().decompress(packed.as_py()), refs.values.to_numpy()
                at = ref & ((1 << _POS_BITS) - 1)
                starts, ends = np.maximum(at - (length - GRAM), 0).tolist(), (at + length).tolist()
                code += [found.setdefault((key, text[a:b]), len(found))
                         for key, a, b in zip(keys.values.to_pylist(), starts, ends)]
                docs.append(np.full(len(ref), doc.as_py(), np.int64))
                places.append(ref)
                if len(found) >= BATCH_CONTEXTS:
                    yield _context_rows(found, code, docs, places)
                    found, code, docs, places = {}, [], [], []
            if found:
                yield _context_rows(found, code, docs, places)
    return run


def _context_rows(found: dict, code: list[int], docs: list[np.ndarray], refs: list[np.ndarray]) -> pa.RecordBatch:
    of = np.array(code, np.int64)
    order = np.argsort(of, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(found)))]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x)[order])) for x in (docs, refs)]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in found], pa.int64()), pa.array([c for _, c in found], pa.binary()), *lists],
        names=["key", "context", "docs", "refs"])


def _windows(text: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (eight at least) from each of these positions on."""
    out = np.zeros(len(at), np.uint64)
    for k in [*range(0, width - 7, 8), width - 8]:
        word = sliding_window_view(text, 8)[at + k].view(np.uint64)[:, 0]
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) ^ word)
    return out


def alike(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray, context: np.ndarray,
          offset: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the contexts that can share a passage of ``length`` bytes with another context.

    Such a passage leaves ``length - GRAM`` bytes around its anchor, so that one side of the
    anchor is equal for half of them at least. ``key``, ``context`` and ``offset`` (of the anchor
    in it) name the anchors, context i is ``text[starts[i]:ends[i]]``.
    """
    side = (length - GRAM + 1) // 2
    at = starts[context] + offset
    found = []
    for known, begin in ((offset >= side, at - side), (at + GRAM + side <= ends[context], at + GRAM)):
        own, mark = context[known], _mix(key[known] ^ _windows(text, begin[known], side))
        order = np.argsort(mark)
        own, mark = own[order], mark[order]
        cuts = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]])[:len(mark)])
        if len(cuts):
            differ = np.minimum.reduceat(own, cuts) < np.maximum.reduceat(own, cuts)
            found.append(own[np.repeat(differ, np.diff(np.append(cuts, len(own))))])
    return np.unique(np.concatenate(found)) if found else context[:0]


def _least(contexts: list[bytes], first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(context, offsets from, to, document): the smallest document of the passages that start there.

    ``first`` is the smallest document of each context. Sorted by context and offset.
    """
    owner, offset, number = passage_groups(contexts, length)
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(number) > 0]))
    least = np.repeat(np.minimum.reduceat(first[owner], cuts), np.diff(np.append(cuts, len(number))))
    order = np.lexsort((offset, owner))
    owner, offset, least = owner[order], offset[order], least[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) > 0) | (np.diff(least) != 0)]))
    return owner[new], offset[new], offset[np.append(new[1:], len(owner)) - 1], least[new]


def _mark(length: int):
    """For rows (key, context, docs, refs) sorted by key: spans that a smaller document has too.

    Only contexts that can share a passage with another one go into the suffix array; of the
    others the smallest document keeps its copy.
    """
    def spans(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        encoded = table["context"].combine_chunks().dictionary_encode()
        contexts, code = encoded.dictionary, encoded.indices.to_numpy()
        docs = table["docs"].combine_chunks()
        row = np.repeat(np.arange(len(code)), np.diff(docs.offsets.to_numpy()))
        of = code[row]
        doc = docs.flatten().to_numpy()
        ref = table["refs"].combine_chunks().flatten().to_numpy()
        offset = np.minimum(ref & ((1 << _POS_BITS) - 1), length - GRAM)
        start = ref - offset
        # Smallest document of each distinct context, then of each class of passages.
        first = np.full(len(contexts), np.iinfo(np.int64).max)
        np.minimum.at(first, of, doc)
        bounds = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset:contexts.offset + len(contexts) + 1].astype(np.int64)
        text = np.frombuffer(contexts.buffers()[2], np.uint8)
        once = np.concatenate([[True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1])])[:len(row)]
        key = table["key"].to_numpy()[row[once]].view(np.uint64)
        mixed = alike(text, bounds[:-1], bounds[1:], key, of[once], offset[once], length)
        alone = np.ones(len(contexts), bool)
        alone[mixed] = False
        whole = alone[of] & (first[of] < doc)
        out = [(doc[whole], start[whole], start[whole] + (bounds[1:] - bounds[:-1])[of[whole]])]
        if len(mixed):
            owner, low, high, least = _least(contexts.take(pa.array(mixed)).to_pylist(), first[mixed], length)
            begin = np.zeros(len(contexts), np.int64)
            count = np.zeros(len(contexts), np.int64)
            begin[mixed] = np.searchsorted(owner, np.arange(len(mixed)))
            count[mixed] = np.bincount(owner, minlength=len(mixed))
            later = np.flatnonzero(~alone[of])
            for c in range(0, len(later), 1 << 16):
                part = later[c:c + (1 << 16)]
                n = count[of[part]]
                at = np.repeat(part, n)
                run = np.repeat(begin[of[part]] - np.cumsum(n) + n, n) + np.arange(len(at))
                gone = least[run] < doc[at]
                at, run = at[gone], run[gone]
                # Neighbouring runs that go both are one span.
                new = np.concatenate([[True], (at[1:] != at[:-1]) | (run[1:] != run[:-1] + 1)])[:len(at)]
                last = np.append(new[1:], True)[:len(at)]
                out.append((doc[at[new]], start[at[new]] + low[run[new]], start[at[last]] + high[run[last]] + length))
        return _span_rows(*map(np.concatenate, zip(*out)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # Whole keys only: the last key of the batch waits for the next one.
            keys = batch.column(0).to_numpy()
            if not len(keys):
                continue
            if size >= ARRAY_CONTEXTS:
                last = rows[-1].column(0)[rows[-1].num_rows - 1].as_py()
                cut = int(np.searchsorted(keys, last, side="right"))
                if cut < len(keys):
                    yield spans([*rows, batch.slice(0, cut)])
                    rows, size = [], 0
                    batch = batch.slice(cut)
            rows.append(batch)
            size += batch.num_rows
        if rows:
            yield spans(rows)
    return run


def _span_rows(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    tag = start >> _POS_BITS
    low = (1 << _POS_BITS) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(tag, pa.int64()), pa.array(start & low, pa.int64()),
         pa.array(end & low, pa.int64())], names=["doc", "tag", "start", "end"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows (id, packed, starts, ends): what is left after the union of the spans is cut out."""
    open_ = zstandard.ZstdDecompressor
    for batch in batches:
        removed, runs, digests, kept, sizes = [], [], [], [], []
        for packed, starts, ends in zip(batch.column(1), batch.column(2), batch.column(3)):
            text = open_().decompress(packed.as_py())
            sizes.append(len(text))
            if starts.is_valid and len(starts):
                first, last = starts.values.to_numpy(), ends.values.to_numpy()
                order = np.argsort(first, kind="stable")
                first, last = first[order], np.maximum.accumulate(last[order])
                new = np.concatenate([[True], first[1:] > last[:-1]])
                a, b = first[new], last[np.append(new[1:], True)]
                parts = [text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)])]
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                text = b"".join(parts)
            else:
                removed.append(0)
                runs.append(0)
            digests.append(hashlib.sha256(text).hexdigest())
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(digests), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the files of shuffles that nothing refers to any more.

    It does so when the driver's JVM collects its garbage, which a driver with little to do
    may put off until the disks are full. The second round finds what the first has freed.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).

    Bytes covered by a string of ``length`` bytes that also starts in a document with a
    smaller id are removed; strings are judged on the input. Null texts count as empty.
    Rows with a null id take no part: they keep everything and take nothing from others.
    Rows that repeat an id are one document to all others and keep what they share.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} bytes at least")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The tag tells rows with the same id apart.
    tag = F.xxhash64(text).bitwiseAND(F.lit((1 << (63 - _POS_BITS)) - 1).cast("bigint"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), tag.alias("tag"),
                       text.cast("binary").alias("text"))
    known = rows.filter("doc IS NOT NULL")

    whole = cut_lineage(known.select("doc", "tag", F.sha2("text", 256).alias("sha"),
                                     F.length("text").cast("bigint").alias("end")).filter(F.col("end") >= length))
    firsts = cut_lineage(whole.groupBy("sha").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
                         .filter("n > 1"))
    copies = cut_lineage(join_counted(whole, firsts, ["sha"], "n").filter("doc > first").select(
        "doc", "tag", F.lit(0).cast("bigint").alias("start"), "end").distinct())

    shared = cut_lineage(
        map_arrow(map_arrow(known, _find_anchors(length), "key bigint, doc bigint, ref bigint")
                  .repartition("key").sortWithinPartitions("key"), _shared,
                  "key bigint, doc bigint, ref bigint"))
    release_shuffles(spark)  # of all anchors
    wanted = shared.withColumn("tag", F.shiftright("ref", _POS_BITS)).join(copies, ["doc", "tag"], "left_anti").groupBy("doc", "tag").agg(
        F.collect_list("ref").alias("refs"), F.collect_list("key").alias("keys"))
    packed = map_arrow(rows, _pack, "doc bigint, tag bigint, packed binary")
    contexts = map_arrow(packed.join(wanted, ["doc", "tag"]).select("doc", "tag", "packed", "refs", "keys"),
                         _cut_contexts(length),
                         "key bigint, context binary, docs array<bigint>, refs array<bigint>")
    spans = cut_lineage(map_arrow(contexts.repartition("key").sortWithinPartitions("key"), _mark(length),
                                  "doc bigint, tag bigint, start bigint, end bigint").unionByName(copies))
    del wanted, contexts
    release_shuffles(spark)
    marked = spans.groupBy("doc", "tag").agg(F.collect_list("start").alias("starts"),
                                             F.collect_list("end").alias("ends"))
    final = packed.join(marked, ["doc", "tag"], "left").select("doc", "packed", "starts", "ends")
    return map_arrow(final, _remove, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]))
