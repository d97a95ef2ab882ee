"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next.

1. language_id: drops documents without a language (no letters, or mostly noise).
2. line_dedup: takes lines out whose template many documents share; a document of which
   nothing visible is left goes with them.
3. near_dedup: of each group of near copies (SimHash) the document with the smallest id stays.
4. mixing: interleaves the sources in blocks to their target weights; small sources start
   again until every document has been used.
5. bpe: token ids of each text, checked by decoding them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from arealis.llm.bpe import bpe_round_trip
from arealis.llm.language_id import UNKNOWN, identify_languages
from arealis.llm.line_templates import drop_recurring_lines
from arealis.llm.mixing import mix_sources
from arealis.llm.simhash import LINK_BITS, SHINGLE_WORDS, near_duplicates
from arealis.session import cut_lineage

TOKENIZER = "byte_bpe_50k.json"
#: A document goes if more than this part of it is explained by no language.
MAX_NOISE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text a language explains; their columns stay as they are."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"))
    found = identify_languages(rows, keep=("row",), keep_text=True)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("noise") <= MAX_NOISE)).select(
        *[F.col("_text").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; n_chars follows the text."""
    cut = drop_recurring_lines(docs)
    empty = (F.col("n_dropped") > 0) & (F.trim(F.translate("text", "\t\r\n\x0b\x0c", "     ")) == "")
    return cut.filter(~F.coalesce(empty, F.lit(False))).withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("bigint"))
        .otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of four-word shingles, four bits.

    The smallest id of a group stays, the first of the rows that share it; a row without an
    id stays only where no row of its group has one. Rows are told apart by a number of
    their own, so different documents under one id are judged each for itself.
    """
    rows = cut_lineage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                   F.monotonically_increasing_id().alias("no")))
    ids = rows.select(F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), "no")
                      .alias("doc_id"), F.col("row.text").alias("text"))
    groups = near_duplicates(ids, words=SHINGLE_WORDS, bits=LINK_BITS)
    stay = cut_lineage(groups.filter("doc_id = component_id").select("doc_id.no"))
    return rows.join(stay, "no", "left_semi").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mixture; those of small sources come more than once."""
    mixed = mix_sources(docs)
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, in the order of the mixture."""
    return bpe_round_trip(docs, public_tokenizers.path(TOKENIZER), keep=("lang", "source"), with_ids=True,
                          cache_parts=100_000)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("bpe", bpe)]

#: Expectation-maximisation, links of fingerprints and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
