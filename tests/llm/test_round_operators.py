"""Spelling variants, HyperMinHash near duplicates and periodic runs, against brute force."""

import hashlib
import sys
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arealis.llm import hyper_minhash, periodic_runs, queries, spelling_variants
from arealis.llm.components import components
from arealis.llm.hot import join_hashed, join_salted
from arealis.llm.words import split_words

# ---------------------------------------------------------------- helpers


def test_salted_join_gives_all_pairs_of_a_hot_key(spark):
    left = spark.range(300).selectExpr("id AS a", "IF(id < 250, 0, id % 7) AS k")
    right = spark.range(40).selectExpr("id AS b", "IF(id < 20, 0, id % 7) AS k")
    got = Counter(map(tuple, join_salted(left, right, ["k"], part=16).select("a", "b").collect()))
    want = Counter((a.a, b.b) for a in left.collect() for b in right.collect() if a.k == b.k)
    assert got == want


# ---------------------------------------------------------------- spelling variants


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_variants(counts, min_letters, min_count, ratio):
    known = {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}
    near = {w: [v for v in known if distance_one(w, v)] for w in known}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-known[v], v), default=None)
        if best and known[best] >= ratio * known[w]:
            form[w] = best
    out = set()
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), known.get(form.get(w))))
    return out


@pytest.mark.parametrize("seed, letters, sizes", [(1, "ab", (2, 7)), (2, "abcé", (6, 9)), (3, "aàß", (2, 5))])
def test_variants_like_brute_force(spark, seed, letters, sizes):
    rng = np.random.default_rng(seed)
    words = Counter()
    while len(words) < 250:
        word = "".join(rng.choice(list(letters), int(rng.integers(*sizes, endpoint=True))))
        words[word] = int(5 ** rng.integers(0, 5)) + int(rng.integers(0, 3))
        if len(words) > 0.9 * sum(len(letters) ** k for k in range(sizes[0], sizes[1] + 1)):
            break
    df = spark.createDataFrame([*words.items(), (None, 9), ("x" * 9, None)], "word string, n bigint")
    got = {tuple(r) for r in spelling_variants.spelling_variants(df, 3, 2, 5).collect()}
    assert got == brute_variants(words, 3, 2, 5)


def test_words_and_slips_of_awkward_texts(spark, awkward, nothing):
    def count(rows, slips):
        out = Counter()
        for doc, text in rows:
            runs, word = [], ""
            for c in (text or "") + " ":
                c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
                if "a" <= c <= "z" or "À" <= c <= "ÿ":
                    word += c
                else:
                    runs += [word] if word else []
                    word = ""
            for run in runs:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if slips and h % slips == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                out[run] += 1
        return {w: n for w, n in out.items() if len(w) >= 4}

    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for slips in (None, 3, 1):
        got = {r.word: r.n for r in spelling_variants.corpus_words(awkward, min_letters=4, slips=slips).collect()}
        assert got == count(rows, slips)
    assert "straße" in {r.word for r in spelling_variants.corpus_words(awkward).collect()}
    empty = spelling_variants.corpus_words(nothing)
    assert empty.collect() == [] and spelling_variants.spelling_variants(empty).collect() == []


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("abbbbb", 15625), ("abbbba", 78125)]
    df = spark.createDataFrame(chain, "word string, n bigint")
    got = {r.word: r.root for r in spelling_variants.spelling_variants(df).collect()}
    assert set(got.values()) == {"abbbba"}


# ---------------------------------------------------------------- near duplicates


def brute_sets(rows, words=2, percent=80):
    sets = []
    for _, text in rows:
        own = (text or "").encode().lower().split()
        sets.append({tuple(own[i:i + words]) for i in range(max(len(own) - words + 1, 1))} if own else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and label[i] != label[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[label[i]] = min(doc, least.get(label[i], doc))
    return Counter((doc, len(sets[i]), least.get(label[i]), doc is not None and doc == least.get(label[i]))
                   for i, (doc, _) in enumerate(rows))


def near_texts():
    """Copies, edits of all kinds around the limit, a chain, templated pages and tiny texts."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    text = lambda n: list(rng.choice(vocabulary, n))
    docs = []
    for n in (5, 9, 10, 11, 20, 60, 200):
        for _ in range(6):
            base = text(n)
            docs += [base, base + text(int(rng.integers(1, max(2, n // 3)))), base[n // 5:],
                     [w if rng.random() > 0.06 else "edit" for w in base]]
    page = text(120)
    docs += [page[:3 * k] + ["x"] + page[3 * k + 1:] for k in range(40)]
    chain = text(300)
    docs += [chain[12 * k:12 * k + 120] for k in range(14)]
    shell = text(100)
    docs += [shell + text(20) for _ in range(30)]  # a template: about 0.7, nothing to link
    docs += [["a"], ["A"], ["b"], ["a", "b"], ["a", "b", "a", "b"], [], []]
    order = rng.permutation(len(docs))
    return [(None if i % 29 == 7 else int(i), " ".join(docs[j])) for i, j in enumerate(order)] + [(3, None)]


@pytest.mark.parametrize("block", [hyper_minhash.BLOCK, 3])
def test_near_sets_like_brute_force(spark, awkward, block):
    rows = near_texts()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit(1))
    got = Counter(tuple(r) for r in hyper_minhash.near_duplicate_sets(df, block=block).collect())
    assert got == brute_sets(rows)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = Counter(tuple(r) for r in hyper_minhash.near_duplicate_sets(awkward).collect())
    assert got == brute_sets(rows)


def test_near_sets_of_longer_shingles_and_of_nothing(spark, nothing):
    rows = near_texts()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(tuple(r) for r in hyper_minhash.near_duplicate_sets(df, words=5, similarity=0.9).collect())
    assert got == brute_sets(rows, 5, 90)
    assert hyper_minhash.near_duplicate_sets(nothing).collect() == []
    with pytest.raises(ValueError):
        hyper_minhash.near_duplicate_sets(nothing, similarity=0.5)


def test_only_wanted_texts_are_shuffled(spark):
    """op12: every text of the table was packed and shuffled to fetch a few of them."""
    texts = pa.record_batch([pa.array(range(-5000, 5000), pa.int64()), pa.array(range(10000), pa.int64()),
                             pa.array([None if i % 3 == 0 else f"text {i}" for i in range(10000)])],
                            names=["th", "doc_id", "text"])
    wanted = spark.createDataFrame([(t,) for t in range(-5000, 5000, 100)], "own bigint")
    (kept,) = hyper_minhash._pack(hyper_minhash._bits(wanted))([texts])
    assert set(range(-5000, 5000, 100)) <= set(kept.column(0).to_pylist()) and kept.num_rows < 1000
    assert kept.schema.names == ["th", "doc_id", "packed"]
    (none,) = hyper_minhash._pack(hyper_minhash._bits(wanted.limit(0)))([texts])
    assert none.num_rows == 0


def test_every_pair_of_a_large_bucket_meets_once(spark):
    """op12: two unlike sets of a large bucket met twice, on rows that were dealt out twice."""
    roots = [7] * 9 + list(range(100, 121))  # 9 sets of the main component, 21 others
    rows = spark.createDataFrame([(i, 5, r, [(1, 0, 7, 6, 3)]) for i, r in enumerate(roots)],
                                 "no long, n long, root long, places array<struct<key long, band int, main long, blocks int, mains int>>")
    groups = {}
    dealt = hyper_minhash._dealt(rows).collect()
    assert len(dealt) == 21 * (6 + 3) + 9 * 6
    for r in dealt:
        groups.setdefault((r["i"], r["j"]), []).append((r["side"], r["no"]))
    met = Counter()
    for members in groups.values():
        members.sort()
        found = hyper_minhash._pairs(np.array([s for s, _ in members]), np.array([0, len(members)]))
        met.update(frozenset((members[x][1], members[y][1])) for a, b in found for x, y in zip(a.tolist(), b.tolist()))
    assert all(met[frozenset((a, b))] == (roots[a] != roots[b]) for a in range(30) for b in range(a))
    alone = rows.withColumn("places", F.expr("transform(places, p -> named_struct("
                            "'key', p.key, 'band', p.band, 'main', p.main, 'blocks', int(null), 'mains', int(null)))"))
    assert {(r["i"], r["j"], r["side"]) for r in hyper_minhash._dealt(alone).collect()} == {(0, 0, 2)}


def test_estimates_from_registers():
    rng = np.random.default_rng(2)
    for n in (5, 20, 60, 300, 3000):
        found = []
        for _ in range(60):
            x = rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
            common = n * 8 // 9
            a, b = np.unique(x[:n]), np.unique(np.concatenate([x[:common], x[n:2 * n - common]]))
            codes = hyper_minhash.registers([a, b])
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            found.append(hyper_minhash.estimate(codes[:1], codes[1:], np.array([n]), np.array([n]))[0] - exact)
        assert abs(np.mean(found)) < 0.02 and np.abs(found).max() < hyper_minhash.MARGIN
    apart = []
    for _ in range(300):
        codes = hyper_minhash.registers([rng.integers(0, 2 ** 63, 500).astype(np.uint64) for _ in range(2)])
        apart.append((codes[0] == codes[1]).mean())
    assert 0.3 < np.mean(apart) / hyper_minhash.chance_equal(np.array([500]), np.array([500]))[0] < 3


def test_agreement_by_chance_from_one_row_per_size():
    n, m = np.array([1, 40, 300, 5000, 10 ** 6]), np.array([7, 40, 2000, 100, 10 ** 6])
    wanted = np.zeros(len(n))
    for zeros in range(53):
        shares = [np.exp(-load / 2 ** (zeros + 1)) - np.exp(-load / 2 ** zeros) for load in (np.maximum(x / 256, 1) for x in (n, m))]
        wanted += shares[0] * shares[1] / 1024
    assert np.allclose(hyper_minhash.chance_equal(n, m), wanted, rtol=1e-12, atol=0)
    assert hyper_minhash.value_chances(np.zeros(0, np.int64)).shape == (0, 53)


def test_large_bucket_computes_chances_once(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[25:], rng.integers(0, 2 ** 63, 25).astype(np.uint64)])) for _ in range(60)]
    table = pa.table({"key": [1] * 60, "i": [0] * 60, "j": [0] * 60, "side": [2] * 60, "band": [0] * 60,
                      "no": list(range(60)), "n": [len(s) for s in sets], "root": list(range(60)),
                      "regs": [c.tobytes() for c in hyper_minhash.registers(sets)]})
    calls, real = [], hyper_minhash.value_chances
    monkeypatch.setattr(hyper_minhash, "value_chances", lambda n: calls.append(len(n)) or real(n))
    list(hyper_minhash._with_partner(Fraction(4, 5))(iter(table.to_batches())))
    assert calls == [1]  # all sets have 100 elements


def test_hot_keys_are_filtered_not_left_joined(spark):
    rows = [(k, i) for k in range(40) for i in range(3000 if k == 7 else 60 if k == 9 else 2)]
    frame = spark.createDataFrame(rows, "key bigint, v int")
    for keys in ([7, 9, 11, 99], [11, 12], []):
        table = spark.createDataFrame([(k, sum(1 for x, _ in rows if x == k), f"t{k}") for k in keys], "key bigint, m bigint, t string")
        joined = join_hashed(frame, table, "key", "m")
        assert Counter(map(tuple, joined.collect())) == Counter((k, i, f"t{k}") for k, i in rows if k in keys)
        assert joined.columns == ["key", "v", "t"]
        assert "LeftOuter" not in joined._jdf.queryExecution().toString()


def test_components_of_few_links_are_written_by_few_tasks(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i % 10 < 8], "u bigint, v bigint").repartition(7, "u")
    wanted = {tuple(r) for r in components(links).collect()}
    files, module = [], sys.modules["arealis.llm.components"]
    cut = module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: files.append(len((made := cut(df)).inputFiles())) or made)
    for part in (10, 1 << 15):
        files.clear()
        assert {tuple(r) for r in components(links, part).collect()} == wanted
        assert max(files[1:]) <= 48 // part + 1


# ---------------------------------------------------------------- periodic runs


def brute_runs(words, least):
    out, seen = [], set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(least, 2 * q) and (start, end) not in seen:
                seen.add((start, end))
                out.append((start, end - start, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_like_brute_force(least):
    rng = np.random.default_rng(least)
    texts = []
    for _ in range(250):
        words = [str(x) for x in rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 70)))]
        if rng.random() < 0.5 and len(words) > 4:
            a, p = int(rng.integers(0, len(words) - 1)), int(rng.integers(1, 8))
            words = words[:a] + [words[a + (i - a) % min(p, len(words) - a)] for i in range(a, len(words))]
        texts.append(words)
    words, offsets = split_words(pa.array([" ".join(t) for t in texts]))
    got = sorted(zip(*[x.tolist() for x in periodic_runs.runs_in_texts(words, offsets, least)]))
    assert got == sorted((t, *r) for t, w in enumerate(texts) for r in brute_runs(w, least))


def brute_query(doc, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(("" if doc is None else str(doc)).encode())
    g = h // 10
    if doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc, len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_of_runs_like_brute_force(spark, awkward, nothing, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    rows += [(100 + i, " ".join(rng.choice(["a", "b", "ü", "d e"], int(rng.integers(0, 300))))) for i in range(150)]
    rows += [(7000, "one two three " * 40 + "\n\tfour five"), (7001, "same " * 5000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect())
    assert got == Counter(brute_query(*r) for r in rows)
    assert periodic_runs.periodic_runs(nothing).collect() == []
    assert periodic_runs.periodic_runs(awkward).count() == awkward.count()
