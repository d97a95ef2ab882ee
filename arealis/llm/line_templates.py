"""Line deduplication with a log-template tree, in DataFrame operations only.

Every line is parsed to a fixed depth: the number of its tokens, its leading tokens, and
the remaining tokens as the leaf. What varies from copy to copy (words with a digit,
numbers, addresses) is generalised to ``<*>`` on every level; the rest of its token stays.
A line with fewer than four constant letters for each such part is its own template, so
that rows of numbers are not taken for copies of each other. A line's template is its
path through the tree. A template that many documents share is boilerplate: it is
dropped everywhere but in the document with the smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from arealis.session import cut_lineage

from .hot import join_counted

#: A web address, a mail address or a Latin word with a digit; further numbers after one separator belong to it.
VARIABLE = (r"(?<![^ ])https?://[!-~]*+|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*+@[A-Za-z0-9._-]*+"
            r"|(?<![\p{IsLatin}0-9])\p{IsLatin}*+[0-9][\p{IsLatin}0-9]*+(?:[.,:/-][0-9][\p{IsLatin}0-9]*+)*+")
#: With fewer constant letters than this for each variable part, a line is compared as it is.
CONSTANT_LETTERS = 4
MIN_DOCS = 10
LEAD_TOKENS = 2


def template(line: Column) -> Column:
    """The line with variable parts generalised, or as it is if little else is in it; empty for a blank line."""
    plain = F.trim(F.translate(line, "\t\r\x0b\x0c", "    "))
    masked = F.regexp_replace(plain, VARIABLE, "<*>")
    constant = F.replace(masked, F.lit("<*>"), F.lit(""))
    parts = (F.length(masked) - F.length(constant)) / 3
    letters = F.length(F.regexp_replace(constant, r"\P{L}+", ""))
    # Branches, not one condition: most lines have no variable part and need no masking.
    return F.when(~plain.rlike("[0-9@]|https?://"), plain).when(
        letters >= CONSTANT_LETTERS * parts, masked).otherwise(plain)


def parse_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lead: int = LEAD_TOKENS) -> DataFrame:
    """One row per line that is not blank: doc_id, text_hash, pos, and its path: n_tokens, lead, leaf.

    ``text_hash`` tells rows with the same id apart. ``leaf`` is the rest of the template
    as two independent 64-bit digests.
    """
    lines = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("pos", "line"))
    parsed = lines.select("doc_id", "text_hash", "pos", template(F.col("line")).alias("template")).filter(
        "template <> ''")
    blanks = F.length("template") - F.length(F.translate("template", " ", ""))
    first = F.substring_index("template", " ", lead)
    return parsed.select(
        "doc_id", "text_hash", "pos", (blanks + 1).alias("n_tokens"), F.xxhash64(first).alias("lead"),
        F.struct(F.xxhash64("template").alias("a"),
                 F.xxhash64(F.lit(1), F.reverse("template")).alias("b")).alias("leaf"))


def recurring_templates(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Templates of at least ``min_docs`` documents: path, n (lines), n_docs, first_doc."""
    path = ["n_tokens", "lead", "leaf"]
    return (lines.groupBy(*path, "doc_id").agg(F.count("*").alias("n"))
            .groupBy(*path).agg(F.sum("n").alias("n"), F.count("*").alias("n_docs"),
                                F.min("doc_id").alias("first_doc"))
            .filter(F.col("n_docs") >= min_docs))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = MIN_DOCS, lead: int = LEAD_TOKENS) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text_col``, and n_lines, n_dropped.

    A line is dropped if its template is in at least ``min_docs`` documents and this
    document is not the one with the smallest id among them. Blank lines stay. A null
    text stays null (no lines). Rows that repeat an id count as one document. Columns
    named n_lines or n_dropped are replaced.
    """
    lines = cut_lineage(parse_lines(docs, id_col, text_col, lead))
    path = ["n_tokens", "lead", "leaf"]
    hits = join_counted(lines, cut_lineage(recurring_templates(lines, min_docs)), path, "n").filter(
        ~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    dropped = hits.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"),
                       F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"),
                       F.split(F.col(text_col), "\n").alias("lines"))
    marked = rows.join(dropped, rows["id"].eqNullSafe(dropped["doc_id"])
                       & (rows["hash"] == dropped["text_hash"]), "left")
    gone = F.coalesce(F.col("dropped"), F.array().cast("array<int>"))
    at = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone))
    text = F.when(F.size(gone) == 0, F.col(f"row.`{text_col}`")).otherwise(
        F.array_join(F.transform(at, lambda i: F.get("lines", i)), "\n"))
    return marked.select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in kept_columns],
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.size(gone).cast("bigint").alias("n_dropped"))
