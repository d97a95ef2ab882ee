"""Periodic runs of words, found with an enhanced suffix array and without tree nodes.

A run is a stretch of words with smallest period q that is at least twice as long as q and
cannot be extended by a word on either side. At its right end stands a square of two
copies of length q that no further word continues: two suffixes q apart whose common prefix
is exactly q, so that they hang below different children of the interval of depth q of
the longest common prefixes (a branching tandem repeat). For each interval the suffixes of
all children but the largest are tried: does the inverse suffix array put position + q or
position - q into the interval? A suffix is in a smaller child of at most log(n) intervals.
Squares found so are rotated to the left as long as words repeat, and those with the same
ends are one run, whose period is the smallest.

Intervals are not walked: their bounds are the next smaller common prefixes on both sides,
found for all places at once by halving steps over range minima.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .ship import map_arrow
from .words import row_groups, split_words

MIN_LENGTH = 12
#: Suffixes of smaller children that are tried at once.
_CHUNK = 1 << 20

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _regroup(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (first, second), and where a new pair of values begins in it."""
    order = np.argsort(second, kind="stable")
    order = order[np.argsort(first[order], kind="stable")]
    a, b = first[order], second[order]
    return order, np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])


def _tied(new: np.ndarray) -> np.ndarray:
    return ~new | ~np.append(new[1:], True)


def rank_levels(keys: np.ndarray, upto: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and their ranks by the first 1, 2, 4, ... keys until all ranks differ.

    The rank of a suffix is the place where the suffixes that share these keys begin. Every
    repeated stretch must end before the last key. With ``upto``, ranks by so many keys at
    most are computed.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, h = [rank], 1
    while upto is None or 2 * h <= upto:
        at = np.flatnonzero(_tied(new))
        if not len(at):
            break
        suffix = order[at]
        moved, fresh = _regroup(rank[suffix], rank[suffix + h])
        order[at] = suffix[moved]
        new[at] = fresh
        rank = rank.copy()
        rank[order[at]] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank)
        h *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``order``; 0 for the first."""
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 2, -1, -1):
        step = (levels[level][a] == levels[level][b]).astype(np.int64) << level
        a += step
        b += step
    return np.concatenate([[0], b - order[1:]])


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, left, right): for each place with a common prefix, the interval it parts in children.

    ``left`` and ``right`` are the first and last suffix of the interval.
    """
    n = len(lcp)
    at = np.flatnonzero(lcp > 0)
    depth = lcp[at]
    closed = np.diff(np.concatenate([[-1], np.flatnonzero(lcp == 0), [n]]))  # no interval is wider
    minima, h = [lcp.astype(np.int32)], 1
    while 2 * h <= closed.max():
        last = minima[-1]
        minima.append(np.minimum(last[:len(last) - h], last[h:]))
        h *= 2
    left, right = at.copy(), at.copy()  # [left, right] covers places with prefixes >= depth
    for level in range(len(minima) - 1, -1, -1):
        h, low = 1 << level, minima[level]
        start = left - h
        fit = (start >= 0) & (low[np.maximum(start, 0)] >= depth)
        left = np.where(fit, start, left)
        start = right + 1
        fit = (start + h <= n) & (low[np.minimum(start, len(low) - 1)] >= depth)
        right = np.where(fit, right + h, right)
    return at, left - 1, right


def branching_squares(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that the word after it does not continue."""
    at, left, right = intervals(lcp)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    by_node = np.lexsort((at, right, left))
    at, left, right = at[by_node], left[by_node], right[by_node]
    new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    # The children of a node: from its left end to its first place, then from place to place.
    heads = np.flatnonzero(new)
    node = np.cumsum(new) - 1
    first = heads + np.arange(len(heads))
    starts = np.empty(len(at) + len(heads), np.int64)
    starts[np.arange(len(at)) + node + 1] = at
    starts[first] = left[heads]
    owner = np.repeat(np.arange(len(heads)), np.diff(np.append(first, len(starts))))
    stops = np.append(starts[1:], 0)
    last = np.append(first[1:], len(starts)) - 1
    stops[last] = right[heads] + 1
    size = stops - starts
    largest = np.maximum.reduceat(size, first)
    is_large = np.flatnonzero(size == largest[owner])
    large = np.full(len(heads), -1, np.int64)
    large[owner[is_large][::-1]] = is_large[::-1]
    depth = lcp[at[heads]]
    small = np.flatnonzero(large[owner] != np.arange(len(starts)))
    found = []
    load = np.cumsum(size[small])
    cuts = np.searchsorted(load, np.arange(_CHUNK, load[-1] + _CHUNK, _CHUNK)) if len(load) else []
    low = 0
    n = len(order)
    for high in np.minimum(np.asarray(cuts, np.int64) + 1, len(small)).tolist():
        child = small[low:high]
        low = max(low, high)
        if not len(child):
            continue
        many = size[child]
        own = np.repeat(child, many)
        place = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + starts[own]
        suffix, of = order[place], owner[own]
        q = depth[of]
        ahead = rank[np.minimum(suffix + q, n - 1)]
        fit = (suffix + q < n) & (ahead >= left[heads][of]) & (ahead <= right[heads][of]) & (
            (ahead < starts[own]) | (ahead >= stops[own]))
        found.append((suffix[fit], q[fit]))
        behind = rank[np.maximum(suffix - q, 0)]
        fit = (suffix >= q) & (behind >= starts[large[of]]) & (behind < stops[large[of]])
        found.append((suffix[fit] - q[fit], q[fit]))
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64),) * 2


def runs_of(keys: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of ``keys`` of at least ``min_length``, by start and period.

    The last key must occur once; keys of different texts must differ.
    """
    order, levels = rank_levels(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    start, period = branching_squares(order, rank, common_prefixes(order, levels))
    stop = start + 2 * period
    for level in range(len(levels) - 1, -1, -1):  # rotate to the left
        before = start - (1 << level)
        same = (before >= 0) & (levels[level][np.maximum(before, 0)] == levels[level][np.maximum(before, 0) + period])
        start = np.where(same, before, start)
    long = stop - start >= min_length
    start, stop, period = start[long], stop[long], period[long]
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    by = np.lexsort((period, start))
    return start[by], (stop - start)[by], period[by]


def _repeating(keys: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Numbers of the texts in which two suffixes share ``least`` words; others have no run.

    In a run of period q at least max(least, q) words are common to the suffixes at its
    start and q words later, if ``least`` is half the smallest length.
    """
    order, levels = rank_levels(keys, least)
    h = 1 << (len(levels) - 1)
    rank = levels[-1]
    many = np.bincount(rank, minlength=len(keys)) > 1
    at = np.flatnonzero(many[rank])
    if h < least and len(at):
        _, new = (made := _regroup(rank[at], rank[at + least - h]))
        at = at[made[0]][_tied(new)]
    return np.unique(np.searchsorted(ends, at, side="right"))


def runs_in_texts(words: pa.Array, offsets: np.ndarray, min_length: int) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of the runs within texts, given all words and the texts' offsets."""
    texts = len(offsets) - 1
    sizes = np.diff(offsets)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    width = int(ids.max(initial=0)) + 2

    def keyed(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys that differ between texts, with a key of its own after each text, and the texts' ends."""
        many = sizes[chosen]
        ends = np.cumsum(many + 1)
        text = np.repeat(np.arange(len(chosen)), many + 1)
        keys = text * width + (width - 1)
        inside = np.ones(len(keys), bool)
        inside[ends - 1] = False
        word = np.repeat(offsets[chosen] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        keys[inside] = text[inside] * width + ids[word]
        return keys, ends

    chosen = np.flatnonzero(sizes >= min_length)
    for least in ((min_length + 1) // 2, None):
        if not len(chosen):
            return (np.zeros(0, np.int64),) * 4
        keys, ends = keyed(chosen)
        if least:
            chosen = chosen[_repeating(keys, ends, least)]
    start, length, period = runs_of(keys, min_length)
    text = np.searchsorted(ends, start, side="right")
    return chosen[text], start - (ends - sizes[chosen] - 1)[text], length, period


def _collapse(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in row_groups(batch.column(1)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                words, offsets = split_words(part.column(1))
                text, start, length, period = runs_in_texts(words, offsets, min_length)
                turn = np.zeros(len(words) + 1, np.int64)
                np.add.at(turn, offsets[text] + start + period, 1)
                np.add.at(turn, offsets[text] + start + length, -1)
                kept = np.cumsum(turn)[:-1] == 0
                before = np.concatenate([[0], np.cumsum(kept)])[offsets]
                lines = pa.ListArray.from_arrays(pa.array(before, pa.int32()), words.filter(pa.array(kept)))
                bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                runs = pa.StructArray.from_arrays(
                    [pa.array(v, pa.int64()) for v in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                     pc.binary_join(lines, " ")], names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period), collapsed.

    ``runs``: stretches of at least ``min_length`` words and two periods, by start and
    period; words are numbered from 0. ``collapsed``: the words, joined by one space,
    without those that lie in a run after its first period. A null, empty or blank text
    has no word, no run and an empty ``collapsed``. Every row is judged by itself, so
    repeated ids and rows and null ids do not matter. A text is held whole by one task,
    with some 100 bytes a word, more for a long text of one period (8 bytes for each
    doubling of the longest repeat).
    """
    if min_length < 2:
        raise ValueError("min_length must be 2 at least")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([
            T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType())])
    return map_arrow(source, _collapse(min_length), schema)
