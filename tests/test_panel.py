import math

import pytest
from pyspark.sql import functions as F

from arealis.functions import calendar as cal
from arealis.operators import demographics as demo, panel as p, skew
from arealis.plans.feature_table import base_panel


@pytest.fixture()
def events(spark):
    rows = [("a", "2020-01"), ("a", "2020-01"), ("a", "2020-04"), ("b", "2021-02"), ("b", "2020-04")]
    return spark.createDataFrame(rows, "loc string, Month string")


def test_time_columns(events):
    rows = {r["Month_text"]: r for r in p.normalize_time(events).collect()}
    assert rows["2020-04"]["time_index_norm"] == pytest.approx(3 / 12)
    assert rows["2021-02"]["time_index_norm"] == pytest.approx(13 / 12)   # may exceed 1 by definition
    assert rows["2020-04"]["month_sin"] == pytest.approx(math.sin(math.pi / 2))


def test_one_year_span_divides_by_one(spark):
    df = spark.createDataFrame([("a", "2020-01"), ("a", "2020-03")], "loc string, Month string")
    assert sorted(r["time_index_norm"] for r in p.normalize_time(df).collect()) == [0.0, 2.0]


def test_malformed_month_fails(spark):
    df = spark.createDataFrame([("a", "2020-13")], "loc string, Month string")
    with pytest.raises(Exception):
        p.normalize_time(df).collect()


def test_grid_is_dense_and_keeps_every_event(events):
    grid = p.densify_grid(p.normalize_time(events), "loc", "n").collect()
    assert len(grid) == 2 * 3 and sum(r["n"] for r in grid) == 5
    cell = {(r["loc"], r["year"], r["month"]): r["n"] for r in grid}
    assert cell[("a", 2020, 1)] == 2 and cell[("a", 2021, 2)] == 0


def test_calendar_grid_fills_absent_months(events):
    grid = p.densify_grid(p.normalize_time(events), "loc", "n", calendar=True)
    assert grid.count() == 2 * 14 and grid.agg(F.sum("n")).first()[0] == 5


def test_preaggregated_panel_equals_direct_one(events):
    direct = p.densify_grid(p.normalize_time(events), "loc", "n").select("loc", "year", "month", "n")
    via = base_panel(events, "loc", "n").select("loc", "year", "month", "n")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, via.collect()))


def test_month_arguments():
    assert cal.parse_year_month("2025-03") == (2025, 3)
    for bad in ("2025", "2025-13", "x-1", "2025-0"):
        with pytest.raises(ValueError):
            cal.parse_year_month(bad)
    with pytest.raises(ValueError):
        cal.month_sequence("2025-03", "2025-02")


def test_extrapolation_before_and_after(spark):
    df = spark.createDataFrame([("a", 2011, 100, 10.0), ("a", 2013, 105, 12.0), ("b", 2012, 7, 1.0)],
                               "loc string, year int, population long, population_density double")
    got = {(r["loc"], r["year"]): r for r in demo.extrapolate_years(df, [2010, 2014], "loc").collect()}
    assert got[("a", 2014)]["population"] == 108            # 107.5 away from zero
    assert got[("a", 2010)]["population"] == 98             # 97.5
    assert got[("a", 2014)]["population_density"] == pytest.approx(13.0)
    assert got[("b", 2014)]["population"] is None           # one year has no slope


def test_a_large_grid_is_dealt_out_by_its_rows(spark, monkeypatch):
    """Not by the few bytes of the counts that it is made of."""
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    events = spark.range(900).select((F.col("id") % 300).cast("string").alias("loc"), F.concat(
        F.lit("2020-0"), (1 + F.col("id") % 8).cast("string")).alias("Month"))
    grid = p.densify_grid(p.normalize_time(events), "loc", "n")
    assert grid.agg(F.count("*"), F.sum("n")).first()[:] == (2400, 900)
    assert grid.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 400
