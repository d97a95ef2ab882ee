"""The checked queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from arealis.functions.scalars import let

from .ann_forest import nearest
from .bpe import bpe_round_trip
from .exact_dedup import exact_duplicates
from .hyper_minhash import near_duplicate_sets
from .language_id import identify_languages
from .line_templates import drop_recurring_lines
from .mixing import mix_sources
from .periodic_runs import periodic_runs
from .simhash import near_duplicates
from .spelling_variants import corpus_words, spelling_variants
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .url_cascade import judge_urls

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents")).drop("n_chars")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).drop("exact")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


#: The rules of the query. A rule's path begins with the slash after its host.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(corpus_words(_table(spark, sf_dir, "documents"), slips=199))


def op12_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_sets(_table(spark, sf_dir, "documents"))


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by crc32 of its id, the words from one on repeat a stretch of them.

    With h = crc32(id), g = h // 10 and n words: if h % 10 = 0, each word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def looped(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, let(words, looped)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_loops(_table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                               r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_bpe": op3_bpe,
    "op4_nearest": op4_nearest,
    "op5_url_filter": op5_url_filter,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hyper_minhash": op12_hyper_minhash,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
    translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ', '') AS plain
  FROM documents),
g AS (SELECT plain, count(*) AS group_size,
    first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id FROM t GROUP BY plain)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.plain) AS text_sha256
FROM t JOIN g ON t.plain = g.plain""",
    "op5_url_filter": r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id
    ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS nth
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM f WHERE nth = 1) f ON f.page_id = p.page_id""",
    "op8_line_dedup": r"""
WITH l AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM l),
t AS (SELECT doc_id, line, pos, array_to_string(list_transform(
    string_split(trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ')), ' '),
    lambda x: CASE WHEN regexp_matches(x, '[0-9@]|^https?://') THEN '<*>' ELSE x END), ' ') AS template
  FROM u),
r AS (SELECT template, min(doc_id) AS first_doc FROM t WHERE template <> '' GROUP BY template
  HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT t.*, r.template IS NOT NULL AND t.doc_id <> r.first_doc AS gone
  FROM t LEFT JOIN r ON t.template = r.template)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op11_spelling_variants": r"""
WITH RECURSIVE steps AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i))),
runs AS (SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY doc_id, run),
h AS (SELECT run, k, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
      THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM runs, steps),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, k FROM h),
v AS (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cuts AS (SELECT word, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS gap, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM v, LATERAL unnest(range(1, length(word) + 1)) AS r(i)),
pairs AS (SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cuts c JOIN v ON v.word = c.less
  UNION SELECT v.word, c.word FROM cuts c JOIN v ON v.word = c.less),
near AS (SELECT a AS word, count(*) AS n_near, max(n) AS top, arg_min(b, {'less': -n, 'word': b}) AS best
  FROM pairs JOIN v ON v.word = b GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * v.n THEN best END AS form,
    CASE WHEN top >= 5 * v.n THEN top END AS form_n FROM v LEFT JOIN near ON near.word = v.word),
chain AS (SELECT word, word AS at, form AS ahead FROM f
  UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN f ON f.word = chain.ahead)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word AND chain.ahead IS NULL""",
}
