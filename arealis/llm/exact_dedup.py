"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A text without its white space is cut into blocks of fixed size. The distinct blocks
of the corpus are sorted and numbered: the number is the block's name. Then adjacent
pairs of names are named the same way, pairs of these pairs again, until each text has
one name. Equal texts, and no others, have the same name on the same level.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from arealis.session import cut_lineage

from .hot import join_counted

#: Fixed value: the characters that do not count when texts are compared.
WHITE_SPACE = "\t\n\x0b\x0c\r "

BLOCK_CHARS = 2048


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS,
                     digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal if they are identical without white space; null counts as empty.
    Of equal texts the one with the most code points in the original stays, then the
    one with the smallest id; a null id comes last. Rows that share text, length and
    id are equal in all that is compared: each is ``kept`` if one of them is.

    ``digest`` only speeds up the lookup of a block's name. Blocks that share a digest
    are told apart by their text.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "plain", F.translate("text", WHITE_SPACE, ""))
    cut = F.regexp_extract_all("plain", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))

    # Names of the distinct blocks. One shuffle of the text, combined per task before it.
    blocks = texts.select(F.explode(cut).alias("block")).select(digest(F.col("block")).alias("key"),
                                                                "block")
    distinct = (blocks.groupBy("key").agg(F.collect_set("block").alias("same_key"),
                                          F.count("*").alias("n")))
    names = cut_lineage(
        distinct.select("key", F.explode("same_key").alias("block"), "n",
                        (F.size("same_key") > 1).alias("clash"))
        .sortWithinPartitions("block")
        .select("key", F.when(F.col("clash"), F.col("block")).alias("block"),
                F.monotonically_increasing_id().alias("name"), "n"))
    # About one pair of blocks in 2**64 shares its digest, so this list is empty or tiny.
    clashes = [r["key"] for r in names.filter("block IS NOT NULL").select("key").distinct().collect()]

    # What is known of each row, and the digests of its blocks. The row number is written
    # with them, so that a lost executor cannot change it.
    keyed = F.transform(cut, lambda b: F.struct(
        digest(b).alias("key"),
        (F.when(digest(b).isin(clashes), b) if clashes else F.lit(None).cast("string")).alias("block")))
    rows = cut_lineage(texts.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256"), keyed.alias("blocks")))

    level = 0
    finished = [rows.filter(F.size("blocks") == 0).select(
        "row", F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("name"))]
    current = cut_lineage(join_counted(
        cut_lineage(rows.select("row", F.size("blocks").alias("length"),
                                F.posexplode("blocks").alias("pos", "b"))
                    .select("row", "length", "pos", "b.key", "b.block")),
        names, ["key", "block"], "n").select("row", "length", "pos", "name"))
    while True:
        finished.append(current.filter("length = 1").select("row", F.lit(level).alias("level"), "name"))
        longer = current.filter("length > 1")
        if longer.isEmpty():
            break
        pairs = cut_lineage(
            longer.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.ceil(F.col("length") / 2)).cast("int").alias("length"),
                 F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                 F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))),
                            F.lit(-1)).cast("bigint").alias("right")))
        pair_names = cut_lineage(
            pairs.groupBy("left", "right").agg(F.count("*").alias("n"))
            .sortWithinPartitions("left", "right")
            .withColumn("name", F.monotonically_increasing_id()))
        current = cut_lineage(join_counted(pairs, pair_names, ["left", "right"], "n")
                              .select("row", "length", "pos", "name"))
        level += 1

    identity = finished[0]
    for part in finished[1:]:
        identity = identity.unionByName(part)
    named = cut_lineage(rows.drop("blocks").join(identity, "row"))
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("last"),
                          F.col("doc_id").alias("doc_id"), F.col("n_chars").alias("n_chars")))
    groups = (named.groupBy("level", "name").agg(F.count("*").alias("n"), best.alias("best"))
              .select("level", "name", "n", F.col("n").alias("group_size"),
                      F.col("best.doc_id").alias("keep_id"), F.col("best.n_chars").alias("keep_chars")))
    return join_counted(named, cut_lineage(groups), ["level", "name"], "n").select(
        "doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))
         & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        "text_sha256", "n_chars")
