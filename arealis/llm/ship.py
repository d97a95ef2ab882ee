"""Python functions over Arrow batches, with this package on the executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from arealis.ship import map_arrow, ship

__all__ = ["map_arrow", "ship", "small_batches"]

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """Tables written inside get Arrow batches of ``size`` bytes at most: less memory where rows are large."""
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES) if before is None else spark.conf.set(_BATCH_BYTES, before)
