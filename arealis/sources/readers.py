"""Readers."""

from __future__ import annotations

from collections.abc import Sequence
from os import PathLike, fspath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.tree import tree_schema
from . import schemas


def to_dataframe(spark: SparkSession, source) -> DataFrame:
    """A Parquet path or a DataFrame -> DataFrame; anything else is a ``TypeError``."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, (str, PathLike)):
        return spark.read.parquet(fspath(source))
    raise TypeError("source must be a path or a DataFrame")


def find_location(df: DataFrame, candidates: Sequence[str] = schemas.LOCATION_NAMES) -> str:
    """First known name of the location column."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no location column among {', '.join(candidates)}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header (all columns text) or a Parquet table, by the name of the path."""
    if path.lower().endswith((".csv", ".csv.gz")):
        return strip_bom(spark.read.csv(path, header=True, inferSchema=False))
    return spark.read.parquet(path)


def scan_lookup(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType | None = None,
                **options) -> DataFrame:
    """Named columns of a CSV; the projection is pushed into the scan.

    Without a schema the header gives the names and every column is text.
    """
    reader = spark.read.options(header=True, **options)
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path, inferSchema=False)
    return strip_bom(df).select(*[F.col(f"`{c}`") for c in columns])


def strip_bom(df: DataFrame) -> DataFrame:
    """Drop a byte-order mark that ended up in the first column name."""
    first = df.columns[0]
    clean = first.lstrip("﻿")
    return df if clean == first else df.withColumnRenamed(first, clean)


def read_events(spark: SparkSession, folder: str, pattern: str = "*-street.csv",
                schema: T.StructType = schemas.EVENTS) -> DataFrame:
    """All extracts below a folder; Spark splits the files over the executors."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
            .option("header", True).schema(schema).csv(folder))


def read_json_tree(spark: SparkSession, paths: str | Sequence[str], entry: T.StructType | None = None,
                   document: bool = False) -> DataFrame:
    """Nested tree from the first path that exists -> rows with a ``tree`` map column.

    The exported layout has one valid document per line and is split over the
    executors; ``document=True`` reads files that are one indented document each.
    """
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            text = spark.read.text(path, wholetext=document)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        return text.select(F.from_json("value", tree_schema(entry)).alias("tree"))
    raise FileNotFoundError(f"no prediction tree at {paths}")
