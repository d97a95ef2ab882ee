"""Session helpers: a local session for tests and benches, and lineage cutting."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "arealis", memory: str = "12g",
                  partitions: int = 8) -> SparkSession:
    """A ``local[n]`` session with the settings the operators assume.

    On a cluster the session comes from ``spark-submit``; nothing in the package
    depends on the values below except the UTC time zone.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Local tables are small but the window and array work on them is not: keep the threads busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Projections of many window features exceed what the JVM compiles as one method.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_written: list[str] = []


def tables_written() -> int:
    """How many tables ``cut_lineage`` has written in this process and not removed."""
    return len(_written)


def remove_tables(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that ``cut_lineage`` has written, but for the first ``since``.

    For the end of a job, when its results have been written: frames built on these
    tables cannot be read afterwards.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(_written) > since:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def job_session(app: str) -> SparkSession:
    """Session of a submitted job: master and resources are the submitter's, the time zone
    and the method size are what the operators assume."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A session with a local master and without that setting (a test, a laptop) gets a
    private folder that goes when the process ends. On a cluster the setting is
    required: a machine-local folder would leave each executor with a part of a table.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share")
        private = tempfile.mkdtemp(prefix="arealis-")
        atexit.register(shutil.rmtree, private, ignore_errors=True)
        sc.setCheckpointDir(private)
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Computed once (a reliable checkpoint computes twice), survives the loss of any
    executor, and gives the following stages its real size, from which the
    optimiser picks join strategies.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
