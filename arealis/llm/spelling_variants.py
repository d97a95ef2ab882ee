"""Spelling variants: words one edit apart, found with asymmetric q-chunks.

Of two words one edit apart, the shorter one (length L) contributes two disjoint chunks of
q = L // 2 letters, its first and its last ones; the other contributes all its positional
grams of q letters. One edit leaves one of the chunks whole: at its place, or moved by the
difference of the lengths, which is one at most. Chunks and grams are therefore joined on
length, letters and place, and the pairs that meet are verified. As q grows with the
words, long words meet on long strings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arealis.session import cut_lineage

from .hot import join_salted
from .ship import map_arrow

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: Different words that a task counts before it hands them on.
_HELD = 1 << 17
#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z have been lower-cased.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _count(min_letters: int, slips: int | None):
    def slipped(word: bytes, head: int) -> bytes:
        h = crc32(word, head)
        if h % slips:
            return word
        letters = word.decode()
        at = h % len(letters)
        return (letters[:at] + letters[at + 1:]).encode()

    def rows(held: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in held.items() if len(w) - w.count(b"\xc3") >= min_letters]
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in kept], pa.string()),
                                           pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                found = Counter(_RUN.findall(bytes(text.as_buffer()).lower()))
                if slips is None:
                    held.update(found)
                else:
                    head = crc32(b"%s:" % (doc.as_py() or "").encode())
                    for word, n in found.items():
                        held[slipped(word, head)] += n
                if len(held) > _HELD:
                    yield rows(held)
                    held = Counter()
        yield rows(held)
    return run


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                 slips: int | None = None) -> DataFrame:
    """(word, n): how often each word of ``min_letters`` letters or more occurs in whole texts.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased.
    ``slips`` plants spelling errors: of a run with crc32("<id>:<run>") divisible by it, the
    letter at crc32 % length is deleted in that document (a null id counts as empty). Null
    and empty texts have no words.
    """
    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = map_arrow(source, _count(min_letters, slips), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): all pairs of different ``words`` (column word, distinct, written) that are one edit apart.

    An edit inserts, deletes or replaces one code point. ``a`` is the shorter word, or the
    smaller one of two of the same length. Words of a single letter have no chunk and are
    left out.
    """
    sized = words.select("word", F.char_length("word").alias("size")).filter("size > 1")

    def part(at: Column, q: Column) -> Column:
        return F.substr("word", at + 1, q)

    q = F.floor(F.col("size") / 2).cast("int")
    chunks = sized.select(F.col("word").alias("a"), "size", F.explode(F.array(*[
        F.struct(at.cast("int").alias("at"), part(at, q).alias("gram")) for at in (F.lit(0), F.col("size") - q)]))
        .alias("c")).select("a", "size", "c.at", "c.gram")
    # Grams for a partner of the same length and for one that is a letter shorter.
    partner = sized.select(F.col("word"), F.col("size").alias("own"),
                           F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("size")).filter("size > 1")
    grams = partner.select("word", "own", "size", q.alias("q"), F.explode(
        F.sequence(F.lit(0), F.col("own") - q)).alias("pos"))
    moved = grams.select("*", F.explode(F.array_distinct(F.array(F.lit(0), F.col("own") - F.col("size")))).alias("shift"))
    # Grams that lie where no chunk can lie after the shift meet nothing: they are not shuffled.
    placed = moved.withColumn("at", F.col("pos") - F.col("shift")).filter(
        (F.col("at") == 0) | (F.col("at") == F.col("size") - F.col("q")))
    grams = placed.select(F.col("word").alias("b"), "size", "at", part(F.col("pos"), F.col("q")).alias("gram"))
    met = join_salted(chunks, grams, ["size", "at", "gram"])
    longer = F.char_length("b") > F.col("size")
    return met.filter((longer | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)).select(
        "a", "b").distinct()


def spelling_variants(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                      ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n) that is long and frequent enough.

    word, form, root, n, n_near, form_n. Two words are near if they are one edit apart;
    ``n_near`` counts a word's near words. Its ``form`` is the near word of largest n (ties:
    smallest in code-point order) if that n is at least ``ratio`` times its own, else null;
    ``root`` is the last word reached by following forms, the word itself without a form.
    Rows that repeat a word are added up; null words and counts are left out.
    """
    if min_letters < 2 or ratio < 2:
        raise ValueError("words need two letters, forms twice the count at least")
    known = cut_lineage(words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
                        .filter((F.char_length("word") >= min_letters) & (F.col("n") >= min_count)))
    pairs = cut_lineage(near_pairs(known))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(known.select(F.col("word").alias("b"), "n"), "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    table = cut_lineage(known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")))
    # Counts grow ratio-fold along the forms, so a chain is short; each round doubles the reach.
    ways = table.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = ways.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        step = cut_lineage(ways.join(ahead, F.col("root") == F.col("_from"), "left").select(
            "word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")))
        ways = step.drop("moved")
        if step.filter("moved").isEmpty():
            break
    return table.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
