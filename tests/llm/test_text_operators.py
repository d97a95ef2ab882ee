"""Exact deduplication, token counts, BPE, lines and language identification on small tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from arealis.llm import bpe, language_id, line_templates
from arealis.llm.exact_dedup import exact_duplicates
from arealis.llm.pieces import safe_pieces
from arealis.llm.token_counts import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHITE = str.maketrans("", "", "\t\n\x0b\x0c\r ")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- exact deduplication


def expected_groups(docs):
    groups = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        groups[(r.text or "").translate(WHITE)].append((r.doc_id, len(r.text or "")))
    out = []
    for plain, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        out += [(i, keep[0], len(members), (i, n) == keep, hashlib.sha256(plain.encode()).hexdigest())
                for i, n in members]
    return Counter(out)


@pytest.mark.parametrize("options", [
    {}, {"block_chars": 3}, {"block_chars": 7, "digest": lambda b: F.length(b).cast("bigint")}])
def test_exact_groups(awkward, options):
    found = exact_duplicates(awkward, **options)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect())
    assert got == expected_groups(awkward)


def test_exact_nothing(nothing):
    assert exact_duplicates(nothing).collect() == []


# ---------------------------------------------------------------- tokens


def test_token_counts_equal_the_library(awkward, library):
    texts = Counter((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False)),
                     len((r.text or "").encode())) for r in awkward.collect())
    for options in ({}, {"piece_chars": 5, "batch_bytes": 30}):
        got = rows(token_counts(awkward, PATH, **options))
        assert Counter((r["doc_id"], r["n_tokens"], r["n_bytes"]) for r in got) == texts
        assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def test_token_counts_nothing(nothing):
    assert token_counts(nothing, PATH).collect() == []


def test_other_tokenizer(sample):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = {r.doc_id: len(model.encode(r.text)) for r in sample.limit(20).collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in rows(token_counts(sample, path)) if r["doc_id"] in want}
    assert got == want


def test_pieces_keep_the_tokens(library):
    rng = random.Random(3)
    parts = ["a", "the ", " word", "\n", "é", "12", "'s", "<|endoftext|>", "  ", "日"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(80)))
        pieces = list(safe_pieces(text, 6))
        assert "".join(pieces) == text
        ids = [t for p in pieces for t in library.encode(p, add_special_tokens=False).ids]
        assert ids == library.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- BPE


def test_bpe_equals_the_library(awkward, library):
    want = Counter()
    for r in awkward.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(back.encode()).hexdigest()] += 1
    got = rows(bpe.bpe_round_trip(awkward, PATH, with_ids=True, keep=("source", "n")))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(r["exact"] and len(r["token_ids"]) == r["n_tokens"] for r in got)


def test_bpe_nothing(nothing):
    assert bpe.bpe_round_trip(nothing, PATH).collect() == []


def test_random_texts_and_small_cache(library):
    rng = random.Random(5)
    parts = ["a", "b", "th", "e ", " the", "\n", "é", "1", " ", "'s", "tion", "日", "\x1c", "\x85", " \t",
             "<|endoftext|>", ",  "]
    coder = bpe.Codec(PATH, cache_parts=50)
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode([text]) == [",".join(map(str, ids))]
        assert coder.decode(coder.encode([text])) == [text]


def test_pair_check_is_what_the_merges_do():
    vocab = bpe.vocabulary(PATH)
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, 50256, (2, 4000))
    fine = vocab.stays(left, right)
    for a, b, ok in zip(left.tolist(), right.tolist(), fine.tolist()):
        assert (vocab.merged(vocab.bytes[a] + vocab.bytes[b]) == [a, b]) == ok
    word = b"abc" * 500  # the queue for long words
    assert vocab.encode_words([word])[0][0] == vocab._merged_long([vocab.letter[c] for c in word])


def test_every_token_is_its_own_encoding():
    vocab = bpe.vocabulary(PATH)
    assert all(vocab.merged(t) == [i] for t, i in list(vocab.known.items())[::37])


# ---------------------------------------------------------------- lines


def test_recurring_lines(spark):
    docs = [(i, f"title {'abcdefghijklm'[i]}\nPosted on day {i} by user{i}@x.org\n\nown words {'nopqrstuvwxyz'[i]}")
            for i in range(13)]
    docs += [(20, None), (21, ""), (22, "Posted on day 99 by me@x.org"), (None, "Posted on day 5 by a@b.c\nx")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in rows(line_templates.drop_recurring_lines(df, min_docs=10))}
    assert got[0]["text"] == docs[0][1] and got[0]["n_dropped"] == 0  # the first keeps it
    for i in range(1, 13):
        assert got[i]["text"] == docs[i][1].replace(f"Posted on day {i} by user{i}@x.org\n", "")
    assert got[20]["text"] is None and got[20]["n_lines"] == 0
    assert got[21]["text"] == "" and got[21]["n_lines"] == 1
    assert got[22]["text"] == "" and got[22]["n_dropped"] == 1
    assert got[None]["text"] == "x"


def test_different_lines_of_numbers_and_without_blanks_stay(spark):
    """Twelve documents each: years, rows of numbers, labelled rows, texts of one token with a digit."""
    kinds = ["{0}", "{0} {1}\t{2}", "Total {0} {1} {2}", "{3}于202{1}年成立。", "{3}在 第{1}章 {3}里", "{3}เปิด202{1}"]
    docs = [(20 * k + i, kind.format(2000 + i, i, 7 * i, "".join(chr(0x4E00 + 40 * i + j) for j in range(9))))
            for k, kind in enumerate(kinds) for i in range(12)]
    docs += [(500 + i, "12 34 56") for i in range(12)]  # the same numbers everywhere
    docs += [(600 + i, f"版权所有，保留一切权利{i}") for i in range(12)]  # only the number differs
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'zh' AS lang", "'s' AS source", "cast(length(text) as bigint) AS n_chars")
    want = {i for i, _ in docs if i < 500} | {500, 600}
    got = line_templates.drop_recurring_lines(df).filter("n_dropped = 0")
    assert {r.doc_id for r in got.collect()} == want
    assert {r.doc_id for r in corpus_pipeline.line_dedup(spark, df, "").collect()} == want


def test_lines_of_awkward_rows_stay(awkward, nothing):
    got = line_templates.drop_recurring_lines(awkward)
    assert Counter(r.text for r in got.collect()) == Counter(r.text for r in awkward.collect())
    assert got.columns.count("n_lines") == 1
    assert line_templates.drop_recurring_lines(nothing).collect() == []


def test_rows_that_share_an_id_are_cut_separately(spark):
    df = spark.createDataFrame(
        [(i, "menu\nbody") for i in range(3)] + [(7, "menu\nfirst"), (7, "second\nmenu")],
        "doc_id bigint, text string")
    got = Counter(r.text for r in line_templates.drop_recurring_lines(df, min_docs=4).collect())
    assert got == Counter({"menu\nbody": 1, "body": 2, "first": 1, "second": 1})


# ---------------------------------------------------------------- languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify_languages(docs, keep=("lang",)).filter("held_out").toPandas()
    assert len(got) > 100 and (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_unknown_texts(awkward, nothing):
    got = rows(language_id.identify_languages(awkward, keep=("text",)))
    assert len(got) == awkward.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") != letters
        assert 0 <= r["score"] <= 1 and (letters or r["score"] == 0)
    assert language_id.identify_languages(nothing).collect() == []


def test_no_labels(awkward):
    got = language_id.identify_languages(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in got.collect()} == {"und"}


def test_mixed_text_has_both_languages(sample):
    langs, table = language_id.fit(sample)
    text = {r.lang: r.text for r in sample.orderBy(F.length("text")).collect() if r.lang in ("en", "de")}
    n = min(len(t) for t in text.values())
    share = language_id.mixtures([(text["en"][:n] + " " + text["de"][:n]).encode()], table)[0]
    assert share[langs.index("en")] > 0.3 and share[langs.index("de")] > 0.3
    assert abs(share.sum() - 1) < 1e-9
