"""Byte-level BPE by speculation: longest matches first, then a check of every adjacent pair.

The merges of a word are one certain token sequence. A sequence of vocabulary tokens is
that sequence exactly if each two neighbours, merged on their own, stay the two tokens
they are. So a word is cut greedily into longest tokens, all neighbouring pairs of a
batch are checked in a few array operations, and only the words with a bad pair go
through the merges one by one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .pieces import safe_pieces
from .ship import map_arrow

#: Fixed value: how the byte-level pre-tokenizer cuts a text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

PIECE_CHARS = 1 << 16
#: Parts and words a worker remembers (about 250 bytes each) before it forgets them and starts anew.
CACHE_PARTS = 400_000
NEVER = np.iinfo(np.int64).max
NO_MERGE = 1 << 62


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters, ids = _byte_letters(), data["model"]["vocab"]
        size = max([*ids.values(), *(t["id"] for t in data["added_tokens"])]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self.single = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.single[b] = ids[letter]
        self.letter: list[int] = self.single.tolist()
        # made[t]: number of the merge that makes t (-1: none); left, right: its parts.
        self.made = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.rank_of: dict[tuple[int, int], int] = {}
        self.product: list[int] = []
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = ids[a], ids[b], ids[a + b]
            self.product.append(z)
            self.rank_of.setdefault((x, y), rank)
            if self.made[z] < 0:
                self.made[z], self.left[z], self.right[z] = rank, x, y
        keys = np.array([x * size + y for x, y in self.rank_of], np.int64)
        order = np.argsort(keys)
        self.size, self.keys = size, keys[order]
        self.ranks = np.array(list(self.rank_of.values()), np.int64)[order]
        self._longest_matches(set(self.special.values()))

    def _longest_matches(self, special: set[int]) -> None:
        """Tokens that their own merges give back, and the longest of them by first five bytes."""
        made = np.flatnonzero(self.made >= 0)
        good = np.ones(self.size, bool)
        good[made] = self.stays(self.left[made], self.right[made], 2 * self.made[made])
        for t in made[np.argsort(self.made[made], kind="stable")].tolist():
            good[t] &= good[self.left[t]] and good[self.right[t]]
        self.known: dict[bytes, int] = {}
        self.reach: dict[bytes, int] = {}
        for i, token in enumerate(self.bytes):
            if token and good[i] and i not in special and (self.made[i] >= 0 or len(token) == 1):
                self.known[token] = i
                if len(token) > 4:
                    self.reach[token[:5]] = max(self.reach.get(token[:5], 4), len(token))

    def stays(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """True where merging the bytes of both tokens leaves the two tokens as they are.

        Goes back in time: of the two parts at the border the one made last is taken
        apart. A pair of parts that both exist would be merged if its merge comes before
        the one that uses up either part; of equal merges the one further left is first.
        ``limit`` holds twice that merge's number, plus one if it is on the right.
        """
        a, b = left.copy(), right.copy()
        limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape).copy()
        fine = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            merges = (self.keys[at] == key) & (2 * self.ranks[at] < limit[live])
            fine[live[merges]] = False
            last_left = self.made[x] > self.made[y]
            done = merges | ((self.made[x] < 0) & (self.made[y] < 0))
            limit[live] = np.where(last_left, 2 * self.made[x], 2 * self.made[y] + 1)
            a[live] = np.where(last_left, self.right[x], x)
            b[live] = np.where(last_left | (self.made[y] < 0), y, self.left[y])
            live = live[~done]
        return fine

    def propose(self, word: bytes) -> list[int]:
        """Longest known token at each place."""
        known, reach, out, at, n = self.known.get, self.reach.get, [], 0, len(word)
        while at < n:
            # Most places have no token of five bytes: then only the shorter ones are tried.
            end = at + reach(word[at:at + 5], 4)
            while (token := known(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = min(end, n)
        return out

    def merged(self, word: bytes) -> list[int]:
        """The merges of a word, one by one, always the earliest in the list."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist() if len(word) > 64 else [
            self.letter[b] for b in word]
        if len(ids) > 64:
            return self._merged_long(ids)
        find = self.rank_of.get
        ranks = [find(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < NO_MERGE:
            i = ranks.index(best)
            ids[i:i + 2] = [z] = [self.product[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = find((ids[i - 1], z), NO_MERGE)
            if i < len(ranks):
                ranks[i] = find((z, ids[i + 1]), NO_MERGE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a queue, for words of any length."""
        n, find, product = len(ids), self.rank_of.get, self.product
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(rank, i, pair) for i, pair in enumerate(zip(ids, ids[1:]))
                 if (rank := find(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i, pair = heapq.heappop(queue)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = product[rank], -1
            after[i] = after[j]
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    before[after[k]] = k
                    pair = ids[k], ids[after[k]]
                    if (rank := find(pair)) is not None:
                        heapq.heappush(queue, (rank, k, pair))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Token ids of each word, and how many words the proposal did not fit."""
        tokens = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter((t for ts in tokens for t in ts), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(words)), sizes)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        fine = self.stays(pairs // self.size, pairs % self.size)
        failing = np.unique(word[inside[~fine[back]]])
        for i in failing.tolist():
            tokens[i] = self.merged(words[i])
        return tokens, len(failing)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Codec:
    """Encoder and decoder of whole texts that remembers what it has seen.

    Texts are cut at single blanks, where a word always begins; the regular expression
    and the tokenizer see each different part between two blanks once.
    """

    def __init__(self, path: str, cache_parts: int = CACHE_PARTS):
        self.vocab, self.cache_parts = vocabulary(path), cache_parts
        self.ids: dict[str, str] = {}  # a part without the blank before it -> its ids
        self.odd: set[str] = set()
        self.words: dict[str, str] = {}
        self.token = {str(i): b for i, b in enumerate(self.vocab.bytes)}
        names = sorted(self.vocab.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _learn_words(self, words: list[list[str]]) -> None:
        seen = set().union(*words)
        new = seen.difference(self.words)
        if len(self.words) + len(new) > self.cache_parts:
            self.words.clear()
            new = seen
        plain = list(new)
        for word, ids in zip(plain, self.vocab.encode_words([w.encode() for w in plain])[0]):
            self.words[word] = ",".join(map(str, ids))

    def _plain(self, texts: list[str]) -> list[str]:
        """Ids of texts without special tokens."""
        parts = [t.split(" ") for t in texts]
        seen = set().union(*[p[1:] for p in parts])
        new = seen.difference(self.ids)
        if len(self.ids) + len(new) > self.cache_parts:
            self.ids.clear()
            self.odd.clear()
            new = seen
        # A blank between two visible characters always begins a word; other blanks may not.
        self.odd.update(p for p in new if not p or p[0].isspace() or p[-1].isspace())
        # Where a blank stands beside white space, the whole text goes through the expression.
        whole = [not self.odd.isdisjoint(p[1:]) or p[0][-1:].isspace() or not p[0] for p in parts]
        fresh = list(new)
        words = [WORDS.findall(" " + p) for p in fresh]
        rest = [[w for piece in safe_pieces(t, PIECE_CHARS) for w in WORDS.findall(piece)]
                if odd else WORDS.findall(p[0]) for t, p, odd in zip(texts, parts, whole)]
        self._learn_words(words + rest)
        find = self.words.__getitem__
        for part, ws in zip(fresh, words):
            self.ids[part] = ",".join(map(find, ws))
        out = []
        for part, ws, odd in zip(parts, rest, whole):
            ids = list(map(find, ws))
            if not odd:
                ids += map(self.ids.__getitem__, part[1:])
            out.append(",".join(ids))
        return out

    def encode(self, texts: list[str]) -> list[str]:
        """The ids of each text, joined by commas."""
        if not self.special or not any(map(self.special.search, texts)):
            return self._plain(texts)
        parts = [self.special.split(t) for t in texts]
        plain = iter(self._plain([p for ps in parts for p in ps[::2]]))
        return [",".join(filter(None, (str(self.vocab.special[p]) if i % 2 else next(plain)
                                       for i, p in enumerate(ps)))) for ps in parts]

    def decode(self, ids: list[str]) -> list[str]:
        """The texts of ids joined by commas."""
        return [b"".join(map(self.token.__getitem__, s.split(","))).decode("utf-8", "replace") if s else ""
                for s in ids]


@lru_cache(maxsize=1)
def codec(path: str, cache_parts: int) -> Codec:
    """One codec for all tasks of a worker process."""
    return Codec(path, cache_parts)


def _groups(values: pa.Array, limit: int) -> Iterator[list[str]]:
    held, size = [], 0
    for value in values:
        text = value.as_py()
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = (), with_ids: bool = False,
                   batch_chars: int = 1 << 20, cache_parts: int = CACHE_PARTS) -> DataFrame:
    """Encode each whole text and decode the ids again.

    One row per row of ``docs``: doc_id, the columns ``keep``, n_tokens, ids_sha256 (of
    the decimal ids joined by commas), decoded_sha256, exact (decoded text = text) and,
    if ``with_ids``, token_ids. Null texts count as empty. ``tokenizer`` is the path of
    a ``tokenizers`` .json file with byte-level BPE, present on every node. A special
    token's string inside a text becomes that token, the library's default. A worker
    remembers ``cache_parts`` words and as many parts of texts, about 250 bytes each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), *keep, text.alias("_text"))
    kept = list(source.schema)[:-1]
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
             T.StructField("decoded_sha256", T.StringType()), T.StructField("exact", T.BooleanType())]
    if with_ids:
        added.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in [*kept, *added]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer, cache_parts)
        for batch in batches:
            start = 0
            for texts in _groups(batch.column(len(kept)), batch_chars):
                ids = coder.encode(texts)
                back = coder.decode(ids)
                columns = [batch.column(i).slice(start, len(texts)) for i in range(len(kept))]
                columns += [
                    pa.array([s.count(",") + 1 if s else 0 for s in ids], pa.int64()),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for s in ids]),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for s in back]),
                    pa.array([a == b for a, b in zip(texts, back)])]
                if with_ids:
                    flat = [np.array(s.split(","), np.int32) if s else np.zeros(0, np.int32) for s in ids]
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(offsets, np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start += len(texts)

    return map_arrow(source, run, T.StructType([*kept, *added]))
