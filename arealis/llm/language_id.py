"""Language identification by multilingual mixtures.

A text is a mixture of languages. Its n-grams are taken in short segments, each of which
is written in one of them; expectation-maximisation finds the proportions from the
segments' likelihoods. The set of languages grows, most likely first, as long as the
likelihood gains more than the penalty for one more language. One further component
spreads its probability evenly over all n-grams and takes what no language explains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .ship import map_arrow

N_GRAM = 3
BUCKETS = 1 << 15
SEGMENT = 24
ROUNDS = 12
SMOOTHING = 0.5
#: Bits of evidence a further language has to bring, besides half the log of the segments.
PENALTY = 6.0
MAX_LANGUAGES = 256
BATCH_BYTES = 1 << 20
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
#: Byte -> symbol: lower-case letters and the bytes of other scripts; all else separates.
_SYMBOL = np.zeros(256, np.uint32)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte of all texts, and where each text starts.

    Bucket 0 is an n-gram of separators only.
    """
    gap = bytes(N_GRAM)
    symbols = _SYMBOL[np.frombuffer(gap.join([*texts, b""]), np.uint8)]
    starts = np.cumsum([0, *(len(t) + N_GRAM for t in texts)])
    n = len(symbols) - N_GRAM + 1
    code = symbols[:n].copy()
    for k in range(1, N_GRAM):
        code = code * np.uint32(155) + symbols[k:n + k]
    some = code != 0
    code ^= code >> np.uint32(15)
    code = (code * np.uint32(2654435769)) >> np.uint32(8)
    return np.where(some, code % np.uint32(BUCKETS - 1) + np.uint32(1), 0), starts


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in groups of about equal bytes, with the first row of each group."""
    held, size, first = [], 0, 0
    for row, value in enumerate(batch.column(column)):
        held.append(value.as_py())
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield first, held
            held, size, first = [], 0, row + 1
    if held:
        yield first, held


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n): n-gram counts over all rows with a language. A task adds up its
    rows and gives at most one row per language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for first, texts in _batches(batch, 0):
                grams, starts = _grams(texts)
                langs = batch.column(1).slice(first, len(texts)).to_pylist()
                for lang in set(langs):
                    if len(counts) > MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    own = [grams[a:b] for a, b, x in zip(starts, starts[1:], langs) if x == lang]
                    found = np.bincount(np.concatenate(own), minlength=BUCKETS)
                    counts[lang] = counts.get(lang, 0) + found
        for lang, n in counts.items():
            at = np.flatnonzero(n[1:]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))],
                names=["lang", "bucket", "n"])

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("binary").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return map_arrow(rows, run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of each bucket (rows) in each (columns).

    The last column is the even component. At most 257 x 32,768 numbers.
    """
    found = count_grams(docs, text_col, lang_col).toArrow().to_pydict()
    langs = sorted(set(found["lang"]))
    place = {x: i for i, x in enumerate(langs)}
    counts = np.full((BUCKETS, len(langs) + 1), SMOOTHING)
    if langs:
        counts[found["bucket"], [place[x] for x in found["lang"]]] += found["n"]
    counts[:, -1] = 1
    table = np.log(counts[1:] / counts[1:].sum(0))
    return langs, np.concatenate([np.zeros((1, len(langs) + 1)), table]).astype(np.float32)


def _em(like: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (text x language) within the allowed sets, and the log-likelihood of each text."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    share = allowed / allowed.sum(1, keepdims=True)
    for step in range(ROUNDS + 1):
        with np.errstate(divide="ignore"):
            joint = like + np.log(share)[doc]
        top = joint.max(1, keepdims=True)
        part = np.exp(joint - top)
        total = part.sum(1, keepdims=True)
        if step == ROUNDS:
            return share, np.add.reduceat((top + np.log(total))[:, 0], starts)
        share = np.add.reduceat(part / total, starts, axis=0) / sizes[:, None]


def mixtures(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Proportions of each language, the even component last, in each text."""
    grams, starts = _grams(texts)
    lengths = np.maximum(np.diff(starts) - N_GRAM, 1)
    sizes = -(-lengths // SEGMENT)
    first = np.cumsum(np.concatenate([[0], sizes[:-1]]))
    inside = np.arange(sizes.sum()) - np.repeat(first, sizes)
    cuts = np.repeat(starts[:-1], sizes) + inside * SEGMENT
    ends = np.minimum(cuts + SEGMENT, np.repeat(starts[:-1] + lengths, sizes))
    bounds = np.stack([cuts, ends], axis=1).ravel()
    # Overlapping n-grams say the same thing N_GRAM times.
    padded = np.concatenate([grams, np.zeros(1, grams.dtype)])
    like = np.add.reduceat(table[padded], bounds, axis=0)[::2] / N_GRAM
    share, _ = _em(like, first, sizes, np.ones((len(texts), table.shape[1])))
    order = np.argsort(-share, axis=1, kind="stable")
    chosen = np.zeros_like(share)
    chosen[np.arange(len(texts)), order[:, 0]] = 1
    share, likelihood = _em(like, first, sizes, chosen)
    # Texts whose set still grows.
    live = np.arange(len(texts))
    for k in range(1, table.shape[1]):
        mine = np.concatenate([np.arange(first[i], first[i] + sizes[i]) for i in live])
        wider = chosen[live].copy()
        wider[np.arange(len(live)), order[live, k]] = 1
        own = sizes[live]
        new, value = _em(like[mine], np.cumsum(np.concatenate([[0], own[:-1]])), own, wider)
        better = value - likelihood[live] > PENALTY + 0.5 * np.log(own)
        live, new, value, wider = live[better], new[better], value[better], wider[better]
        if not len(live):
            break
        share[live], likelihood[live], chosen[live] = new, value, wider
    return share


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", keep: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """doc_id, the columns ``keep``, lang_pred, score and noise of each row of ``docs``, and with
    ``keep_text`` the text itself (null as empty), which then need not be in ``keep`` as well.

    ``lang_pred`` is the language with the largest share, ``und`` if the text is null or
    has no letter or if the model knows no language; ``score`` is its share. ``noise`` is
    the share that no language explains.
    """
    langs, table = model
    source = docs.select(F.col(id_col).alias("doc_id"), *keep,
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kept = list(source.schema)[:-1]
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("noise", T.DoubleType())]
    if keep_text:
        added.append(T.StructField("_text", T.BinaryType()))
    names = [f.name for f in [*kept, *added]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batches(batch, len(kept)):
                known = np.array([bool(langs) and _LETTER.search(t.decode("utf-8", "replace")) is not None
                                  for t in texts])
                best, score, noise = np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts))
                if known.any():
                    share = mixtures([t for t, ok in zip(texts, known) if ok], table)
                    best[known] = share[:, :-1].argmax(1)
                    score[known] = share[:, :-1].max(1)
                    noise[known] = share[:, -1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(first, len(texts)) for i in range(len(kept))]
                    + [pa.array([langs[b] if ok else UNKNOWN for b, ok in zip(best, known)]),
                       pa.array(np.clip(score, 0, 1)), pa.array(np.clip(noise, 0, 1))]
                    + ([batch.column(len(kept)).slice(first, len(texts))] if keep_text else []), names=names)

    found = map_arrow(source, run, T.StructType([*kept, *added]))
    return found.withColumn("_text", F.col("_text").cast("string")) if keep_text else found


def held_out(id_col: str) -> Column:
    """True for the fifth of the ids that no model learns from (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", keep: tuple[str, ...] = (),
                       keep_text: bool = False) -> DataFrame:
    """Fit on the rows that are not held out and predict every row: doc_id, ``keep``, held_out,
    lang_pred, score, noise, and ``_text`` if asked for."""
    model = fit(docs.filter(~held_out(id_col)), text_col, lang_col)
    out = predict(docs, model, id_col, text_col, keep, keep_text)
    return out.select("doc_id", *keep, held_out("doc_id").alias("held_out"), "lang_pred", "score", "noise",
                      *(["_text"] if keep_text else []))
