"""Near duplicates, repeated passages, nearest vectors, URL rules, mixing and the pipeline."""

import hashlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import zstandard
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from arealis.llm import ann_forest, mixing, simhash, suffix_dedup, url_cascade
from arealis.llm.components import components
from arealis.llm.hot import join_counted

# ---------------------------------------------------------------- helpers


def test_counted_join_with_hot_and_null_keys(spark):
    rows = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 2000 END AS k")
    table = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.coalesce(F.col("k"), F.lit(-1)))
    got = join_counted(rows, table, ["k"], "n").filter("v = coalesce(k, -1)")
    assert got.count() == 6000


def test_components_of_chain_star_and_pair(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(-5, -7), (3, 3)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.v: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(50)}, -5: -7, -7: -7}
    assert components(df.filter("u = 3 AND v = 3")).collect() == []


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_classes(rows, bits):
    label = {i: i for i in range(len(rows))}
    fps = [brute_fingerprint(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = label[i], label[j]
                label = {k: b if v == a else v for k, v in label.items()}
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[label[i]] = min(doc, least.get(label[i], doc))
    return Counter((doc, f"{fps[i]:016x}", least.get(label[i])) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("block", [1 << 15, 2])
def test_near_duplicate_classes(awkward, sample, block):
    df = awkward.select("doc_id", "text").unionByName(
        sample.filter("doc_id < 60").select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    got = Counter(tuple(r) for r in simhash.near_duplicates(df, block=block).collect())
    assert got == brute_classes([tuple(r) for r in df.collect()], 4)


def test_near_duplicates_nothing(nothing):
    assert simhash.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("n, centres, bits", [(1500, 4, 4), (1000, 300, 4), (400, 400, 8)])
def test_node_forest_joins_what_all_links_join(n, centres, bits):
    rng = np.random.default_rng(n)
    fps = rng.integers(0, 2 ** 63, centres).astype(np.uint64)[rng.integers(0, centres, n)]
    for _ in range(4):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    fps = np.unique(fps)
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    fps = fps[np.argsort(rank)]

    def classes(pairs):
        root = np.arange(len(fps))
        for a, b in pairs:
            x, y = root[a], root[b]
            if x != y:
                root[root == max(x, y)] = min(x, y)
        return root.tolist()

    distance = np.bitwise_count(fps[:, None] ^ fps[None, :])
    links = simhash.node_forest(fps, bits)
    assert (distance[links[:, 0], links[:, 1]] <= bits).all()
    assert classes(links) == classes(np.argwhere(np.triu(distance <= bits, 1)))
    half = len(fps) // 2
    across = simhash.node_forest(fps, bits, split=half)
    assert ((across < half).sum(axis=1) == 1).all()


# ---------------------------------------------------------------- passages


def brute_removed(rows, length=50):
    first = {}
    for doc, text in rows:
        if doc is not None:
            for i in range(len(text) - length + 1):
                key = text[i:i + length]
                first[key] = min(doc, first.get(key, doc))
    out = Counter()
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        if doc is not None:
            for i in range(len(text) - length + 1):
                if first[text[i:i + length]] < doc:
                    gone[i:i + length] = True
        kept = bytes(c for c, g in zip(text, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc, len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeats_like_brute_force(awkward, sample):
    df = awkward.select("doc_id", "text").unionByName(
        sample.filter("doc_id < 80").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    got = Counter(tuple(r) for r in suffix_dedup.remove_repeats(df).drop("kept").collect())
    assert got == brute_removed([(r.doc_id, (r.text or "").encode()) for r in df.collect()])


def marked_bytes(texts, length=50):
    """Bytes per text that the steps after the anchors mark, in one process; text i is document i."""
    owner, at, key = suffix_dedup.anchors(texts, length)
    own = [np.flatnonzero(owner == i) for i in range(len(texts))]
    rows = [(i, zstandard.compress(t), at[o].tolist(), key[o].view(np.int64).tolist()) for i, (t, o) in enumerate(zip(texts, own))]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([0] * len(rows), pa.int64()),
                                        pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                                        pa.array([r[3] for r in rows], pa.list_(pa.int64()))], names=["doc", "tag", "packed", "refs", "keys"])
    contexts = pa.Table.from_batches(suffix_dedup._cut_contexts(length)(iter([batch]))).sort_by("key")
    gone = [np.zeros(len(t), bool) for t in texts]
    for out in suffix_dedup._mark(length)(iter(contexts.to_batches(max_chunksize=100))):
        for doc, _, start, end in zip(*(c.to_pylist() for c in out.columns)):
            gone[doc][start:end] = True
    return gone, len(set(zip(contexts["key"].to_pylist(), contexts["context"].to_pylist())))


@pytest.mark.parametrize("array_contexts", [1, 1 << 14])
@pytest.mark.parametrize("letters", [2, 26])
def test_only_contexts_that_can_share_a_passage_are_sorted(monkeypatch, letters, array_contexts):
    monkeypatch.setattr(suffix_dedup, "ARRAY_CONTEXTS", array_contexts)
    sorted_ = []
    groups = suffix_dedup.passage_groups
    monkeypatch.setattr(suffix_dedup, "passage_groups", lambda c, n: sorted_.extend(c) or groups(c, n))
    rng = np.random.default_rng(letters)

    def prose(n):
        return (rng.integers(0, letters, n) + 97).astype(np.uint8).tobytes()

    line, long, gram, period = prose(55), prose(400), prose(30), prose(3) * 40
    texts = [prose(int(rng.integers(0, 120))) + part + prose(int(rng.integers(0, 120)))
             for part in [line, long, gram, period, line[:50], line[:49], line[2:], b"", period[1:90]] * 6]
    texts += [line, long[:60], period, b"", texts[1], long + line]
    gone, distinct = marked_bytes(texts)
    want = brute_removed([(i, t) for i, t in enumerate(texts)])
    got = Counter((i, len(t), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()),
                   hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~g])).hexdigest()) for i, (t, g) in enumerate(zip(texts, gone)))
    assert got == want
    assert 0 < len(sorted_) < distinct * 2 / 3


def test_shared_keys_in_any_order_of_documents():
    rng = np.random.default_rng(5)
    key = np.sort(rng.integers(0, 40, 300))
    doc = np.where(key % 3 == 0, key, rng.integers(0, 3, 300))
    table = pa.table({"key": key, "doc": doc, "ref": np.arange(300)})
    several = {k for k in key.tolist() if len(set(doc[key == k].tolist())) > 1}
    for size in (1, 2, 7, 300):
        got = [r for b in suffix_dedup._shared(iter(table.to_batches(max_chunksize=size))) for r in b.column(2).to_pylist()]
        assert got == [r for r, k in enumerate(key.tolist()) if k in several]


def test_repeats_nothing(nothing):
    assert suffix_dedup.remove_repeats(nothing).collect() == []


@pytest.mark.parametrize("n, letters", [(1, 2), (60, 1), (700, 2), (3000, 4), (2500, 200)])
def test_suffix_array_order(n, letters):
    text = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    order = suffix_dedup.suffix_array(text, 50)
    whole = text.tobytes()
    assert sorted(order.tolist()) == list(range(n))
    keys = [whole[i:i + 50] for i in order]
    assert keys == sorted(keys)


# ---------------------------------------------------------------- nearest vectors


def test_nearest_small_table_is_exact_and_skips_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    rows += [(i, rows[0][1]) for i in range(200, 240)]  # ties
    rows += [(300, None), (320, [0.0] * 8), (340, [float("nan")] + [1.0] * 7), (360, [None] + [1.0] * 7),
             (380, []), (400, [1.0, 2.0]), (None, [1.0] * 8), (402, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann_forest.nearest(df).toPandas()
    good = [(i, np.array(v)) for i, v in rows[:240]]
    for q, x in good[::20]:
        own = sorted(((-float(v @ x), i) for i, v in good if i != q))[:20]
        part = got[got.query_id == q].sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21))
        assert np.allclose(part.score, [-s for s, _ in own])
        assert set(part.vec_id[:10]) <= {i for s, i in own} | {i for i, v in good if np.isclose(-float(v @ x), own[-1][0])}
    assert set(got.query_id) == {i for i, _ in good if i % 20 == 0}
    assert ann_forest.nearest(df.limit(0)).collect() == []


def test_ties_go_to_the_smaller_id_wherever_the_copies_lie():
    rng = np.random.default_rng(3)
    for trial in range(4):
        n = 2500 + trial
        vectors = rng.normal(size=(n, 128))
        vectors[rng.choice(n, 30, replace=False)] = vectors[7]
        vectors[-2:] = vectors[7]
        ids, asked = np.arange(n) * 3, vectors[[7, 11]] + 0.01
        q, i, score = ann_forest.search_shard(ids, vectors, np.array([1, 2]), asked, 20, np.linalg.norm(vectors, axis=1).max(), n, 8)
        copies = np.flatnonzero((vectors == vectors[7]).all(axis=1))
        assert i[q == 1].tolist() == ids[copies[:20]].tolist() and len(set(score[q == 1].tolist())) == 1
        assert len(i[q == 2]) == 20 and (np.diff(score[q == 2]) <= 0).all()


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pdf = df.toPandas()
    x, ids = np.stack(pdf.embedding.to_numpy()).astype(float), pdf.vec_id.to_numpy()
    got = ann_forest.nearest(df).toPandas().groupby("query_id").vec_id.apply(set)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(got[ids[q]] & set(ids[np.argsort(-score)[:20]])) / 20)
    assert np.mean(hits) >= 0.9


# ---------------------------------------------------------------- URLs


def brute_verdict(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


@pytest.mark.parametrize("max_bits", [1 << 29, 64])
def test_url_rules(spark, max_bits):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"), *((f"h{i}.org", "/", "block") for i in range(0, 60, 2))]
    urls = [None, "", "no scheme", "http://", "http://net", "http://a.net/", "HTTP://A.Example.NET/en/x?y#z",
            "http://example.net/de/", "http://xexample.com/de/", "http://example.com/de/1", "ftp://q.org/fr/?a",
            "http://q.org?x=/fr/", "http://a..net/b", "http://user@h2.org:80/", "x://y://z.net/",
            *(f"http://www.h{i % 60}.org/fr/{i}" for i in range(300))]
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls + urls[:3])],
                                  "page_id bigint, url string, keys string")
    df = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in url_cascade.judge_urls(pages, df, max_bits=max_bits).collect()}
    assert got == {i: brute_verdict(u, rules) for i, u in enumerate(urls + urls[:3])}


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_cascade.judge_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")]
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    assert url_cascade.judge_urls(pages.limit(0), rules).collect() == []


# ---------------------------------------------------------------- mixing


@pytest.mark.parametrize("weights", [
    {"a": 0.5, "b": 0.25, "c": 0.25}, {"a": 1, "b": 3, "c": 7, "d": 11.5, "e": 0.01}, {"x": 1}])
def test_every_prefix_is_within_one_block(weights):
    parts = mixing.grid_weights(weights, 200)
    slots = mixing.period(parts)
    grid = sum(parts.values())
    assert sorted(s for own in slots.values() for s in own) == list(range(grid))
    for source, own in slots.items():
        for t in range(1, grid + 1):
            assert abs(sum(s < t for s in own) - t * parts[source] / grid) < 1


def test_mixture(spark, awkward, nothing):
    docs = spark.range(1000).selectExpr("id AS doc_id", "CASE WHEN id < 700 THEN 'big' WHEN id < 999 THEN 'mid' END AS source")
    weights = {"big": 2.0, "mid": 1.0, None: 1.0}
    got = mixing.mix_sources(docs, weights, block_rows=10, grid=100).toPandas().sort_values("position")
    assert got.position.is_unique and set(got.doc_id) == set(range(1000))
    order = got.drop_duplicates("slot").source.fillna("none").tolist()
    for t in range(1, len(order) + 1):
        for source, w in (("big", 0.5), ("mid", 0.25), ("none", 0.25)):
            assert abs(order[:t].count(source) - w * t) < 1 + t * 0.005
    again = mixing.mix_sources(docs.repartition(7), weights, block_rows=10, grid=100).toPandas()
    assert sorted(map(tuple, again[["position", "doc_id"]].to_numpy())) == list(
        map(tuple, got[["position", "doc_id"]].to_numpy()))
    mixed = mixing.mix_sources(awkward)
    assert mixed.columns.count("slot") == 1 and mixed.filter("epoch = 0").count() == awkward.count()
    assert mixing.mix_sources(nothing).collect() == []


@pytest.mark.parametrize("weights", [
    {f"s{i:03}": 0.5 if i == 0 else 0.5 / 99 for i in range(100)}, {"hot": 2e6, "tiny": 1.0, "odd": 12345.678},
    {f"s{i:02}": n ** 0.9 for i, n in enumerate([3_333_333] + [350_877] * 19)}])
def test_every_prefix_is_within_one_block_of_the_targets(weights):
    blocks = {s: 4000 if w == max(weights.values()) else 1 for s, w in weights.items()}
    slots = mixing.slots_to_end(mixing.exact_parts(weights), blocks)
    n, total = sum(map(len, slots.values())), sum(map(Fraction, weights.values()))
    assert sorted(x for own in slots.values() for x in own) == list(range(n))
    for source, own in slots.items():
        share = Fraction(weights[source]) / total
        assert len(own) >= blocks[source]
        for k, slot in enumerate(own):  # the count changes at these slots only
            assert abs(k - slot * share) < 1 and abs(k + 1 - (slot + 1) * share) < 1
        assert abs(len(own) - n * share) < 1


def test_targets_hold_for_tiny_and_many_sources(spark):
    docs = spark.range(30_001).selectExpr("id AS doc_id", "CASE WHEN id = 0 THEN 'tiny' WHEN id < 15001 THEN 'hot' "
                                          "ELSE concat('s', id % 99) END AS source")
    got = mixing.mix_sources(docs, block_rows=5).toPandas()
    assert set(got.doc_id) == set(range(30_001)) and got.position.is_unique
    assert (got.source == "tiny").sum() == 1
    sizes = docs.groupBy("source").count().toPandas().set_index("source")["count"] ** 0.9
    order = got.sort_values("position").drop_duplicates("slot").source
    for source in ("hot", "s0", "tiny"):
        ahead = (order == source).cumsum().to_numpy() - np.arange(1, len(order) + 1) * sizes[source] / sizes.sum()
        assert np.abs(ahead).max() < 1


# ---------------------------------------------------------------- pipeline


def test_stages_on_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        out = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = out.columns
            out = stage(spark, out, "/root/testdata/sf0.001")
            assert [c for c in out.columns if c not in ("n_lines", "slot")] == [
                c for c in before if c not in ("n_lines", "slot")], name
            out = spark.createDataFrame(out.collect(), out.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, out, "").collect()
        assert all(r.exact for r in last)
        assert len({r.doc_id for r in last}) == len({r.doc_id for r in out.collect()})


def test_one_of_each_group_of_near_copies_stays(spark):
    """Against brute force: appended, replaced and scattered edits, templated pages, one hot group,
    ids that differ, repeat or are missing, and a column with a name of the stage's own."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: list(rng.choice(vocabulary, n))
    docs = []
    for _ in range(25):
        base = text(200)
        scattered = list(base)
        for at in rng.choice(200, 4, replace=False):
            scattered[at] = "edit"
        docs += [base, base + text(int(rng.integers(4, 54))), base[:60] + text(int(rng.integers(1, 26))) + base[80:], scattered]
    page = text(200)
    docs += [page[:3 * k] + ["x"] + page[3 * k + 1:] for k in range(40)] + [["a", "b"], ["a", "b"], ["a", "c"], [], []]
    texts = [" ".join(d) for d in docs] + [None]
    order = rng.permutation(len(texts))
    rows = [(None if i % 17 == 3 else int(i) // 2 if i < 40 else int(i), texts[j], int(i)) for i, j in enumerate(order)]
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and bin(fps[i] ^ fps[j]).count("1") <= 4:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, no bigint").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) as bigint) AS n_chars", "no", "1 AS row")
    kept = corpus_pipeline.near_dedup(spark, df, "")
    assert kept.columns == df.columns
    kept = kept.collect()
    groups = {}
    for i, own in enumerate(label):
        groups.setdefault(own, []).append(rows[i])
    stay = {label[r.no]: r for r in kept}
    assert len(stay) == len(kept) == len(groups)
    for own, members in groups.items():
        ids = [m[0] for m in members if m[0] is not None]
        assert stay[own].doc_id == (min(ids) if ids else None)
    assert any(len({m[1] for m in g}) > 1 for g in groups.values())
