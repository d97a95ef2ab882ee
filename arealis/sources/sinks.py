"""Sinks. Every task writes its own part; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json_tree(df: DataFrame, path: str, tree: str = "tree", mode: str = "errorifexists") -> None:
    """One document per line; the whole tree is the union of the lines."""
    df.select(F.to_json(tree).alias("value")).write.mode(mode).text(path)
