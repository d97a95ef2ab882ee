import pytest
from pyspark.sql import types as T

from arealis.operators import cleaning, demographics as demo, lookup
from arealis.sources import readers, schemas

HEAD = ",".join(f.name for f in schemas.EVENTS.fields)


def test_events_from_nested_extracts(spark, tmp_path):
    for month, rows in {"2024-01": ["1,2024-01,,,0.1,51.5,, E1 ,Camden 001A,Burglary,,", ",2024-01,,,0.1,51.5,,E1,Camden 001A,Burglary,,",
                                    "2,2024-01,,,0.1,51.5,,E9,Camden 001A,Burglary,,", "3,2024-01,,,0.1,51.5,,E2,Camden 001A,Drugs,,"],
                        "2024-02": ["1,2024-02,,,0.2,51.6,,E1,Camden 001A,Burglary,,", "4,2024-02,,,,,,OLD,Camden 001A,Burglary,,"]}.items():
        folder = tmp_path / month
        folder.mkdir()
        (folder / f"{month}-force-street.csv").write_text("\n".join([HEAD, *rows]))
        (folder / f"{month}-force-outcomes.csv").write_text("a,b\n1,2")
    codes = spark.createDataFrame([("E1", "E1", "U"), ("OLD", "E3", "S"), ("OLD", "E4", "S")],
                                  "LSOA11CD string, LSOA21CD string, CHGIND string")
    got = lookup.collect_events(readers.read_events(spark, str(tmp_path)), codes, kind="Burglary").collect()
    assert sorted((r["Crime ID"], r["Month"], r["LSOA code"]) for r in got) == [("1", "2024-01", "E1"), ("4", "2024-02", "E4")]


def test_sources_of_the_wrong_kind(spark):
    with pytest.raises(TypeError):
        readers.to_dataframe(spark, 5)
    df = spark.range(1)
    assert readers.to_dataframe(spark, df) is df


def test_byte_order_mark(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_bytes("﻿Station,Latitude,Longitude\nOne,51.5,-0.1\n".encode("utf-8"))
    assert readers.scan_lookup(spark, str(path), ["Station", "Latitude"]).first()["Station"] == "One"


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("a", '"1,234"'), ("b", "-"), ("c", None), ("d", "x")], "k string, v string")
    assert [r["v"] for r in cleaning.clean_numeric(df, ["k"]).orderBy("k").collect()] == [1234, 0, 0, None]


def test_land_use_without_values(spark):
    df = spark.createDataFrame([("a", 60.0, 1.0, None), ("b", None, None, 5.0), ("c", None, None, None)],
                               T.StructType([T.StructField("k", T.StringType())] + [
                                   T.StructField(c, T.DoubleType()) for c in (*schemas.RESIDENTIAL_COLUMNS, "Parks (2018)")]))
    got = {r["k"]: (r["residential_pct_2018"], r["is_residential_dominant"]) for r in
           demo.land_use_class(df, schemas.RESIDENTIAL_COLUMNS).collect()}
    assert got == {"a": (61.0, False), "b": (0.0, False), "c": (0.0, False)}


def test_snapshots_drop_early_years(spark):
    panel = spark.createDataFrame([("a", y) for y in (2009, 2012, 2017, 2024)], "loc string, year int")
    one = lambda v: spark.createDataFrame([("a", v)], "loc string, score double")
    versions = lookup.version_union([(one(float(y)), *schemas.IMD_YEARS[y]) for y in (2010, 2015, 2019)])
    got = {r["year"]: r["score"] for r in lookup.snapshot_join(panel, versions, "loc").collect()}
    assert got == {2012: 2010.0, 2017: 2015.0, 2024: 2019.0}


def test_no_machine_local_folder_when_the_session_names_one(spark, tmp_path):
    from arealis import session

    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) + "/" if key == "spark.checkpoint.dir" else default

    class Named:
        conf, sparkContext = Conf(), spark.sparkContext

    assert session.shared_folder(Named()) == str(tmp_path)
    assert session.cut_lineage(spark.range(3)).count() == 3
