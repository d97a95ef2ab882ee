"""Where intermediate tables go."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from arealis.session import cut_lineage, remove_tables, shared_folder, tables_written


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_the_setting_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake(master))


def test_the_setting_is_used():
    assert shared_folder(fake("yarn", "hdfs://x/y/")) == "hdfs://x/y"


def test_written_table_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) AS s")
    again = cut_lineage(df)
    assert again.schema.simpleString() == df.schema.simpleString()
    assert sorted(again.collect()) == sorted(df.collect())


def test_tables_go_at_the_end(spark):
    first = cut_lineage(spark.range(2))
    before = tables_written()
    path = Path(cut_lineage(spark.range(3)).inputFiles()[0].removeprefix("file://")).parent
    assert path.exists()
    remove_tables(spark, before)
    assert not path.exists() and tables_written() == before and first.count() == 2
