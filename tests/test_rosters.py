import json

import pytest
from pyspark.sql import functions as F

from arealis.operators import allocate as al, dashboard as dash, skew, tree
from arealis.plans import roster as plan
from arealis.sources import readers, sinks

AREA = "lad string, lad_name string, ward string, ward_name string, loc string, loc_name string"


def areas(spark, rows):
    return spark.createDataFrame([("L" + w[0], "Lad " + w[0], w, "Ward " + w, c, "Area " + c) for w, c in rows], AREA)


def scores(spark, rows):
    return spark.createDataFrame(rows, "loc string, month_key string, score double")


def test_daily_rules(spark):
    a = areas(spark, [("A1", f"e{i}") for i in range(5)] + [("A2", f"z{i}") for i in range(2)]
              + [("B1", f"m{i:02d}") for i in range(25)])
    rows = [(f"e{i}", "2025-01", 0.3) for i in range(5)]
    rows += [(f"m{i:02d}", "2025-01", 1.0) for i in range(24)] + [("m24", "2025-01", 1e-9)]
    got = {r["loc"]: r["officers_assigned"]
           for r in plan.daily_roster(a, scores(spark, rows), ["2025-01"]).collect()}
    assert [got[f"e{i}"] for i in range(5)] == [20] * 5        # floor boundary
    assert got["z0"] == got["z1"] == 0                         # ward without risk
    assert got["m24"] == 1 and got["m00"] == 4                 # minimum of one officer


def test_hourly_forms(spark):
    d = spark.createDataFrame([("a", 0), ("b", 1), ("c", 100)], "loc string, officers_assigned int")
    profile = al.hour_profile()
    bump = al.allocate_hourly_bump(d, profile)
    assert bump.count() == 72
    one = [r for r in bump.filter("loc = 'b' AND officers_assigned > 0").collect()]
    assert [(r["hour"], r["hour_block"]) for r in one] == [(7, "07:00–07:59")]
    full = {r["loc"]: r["hourly"] for r in al.allocate_hourly_remainder(d, profile).collect()}
    assert full["a"] == [0] * 24 and sum(full["b"]) == 1 and sum(full["c"]) == 100
    total = sum(al.HOURLY_COUNTS)
    assert total == 17095
    floors = [int(100 * c / total) for c in al.HOURLY_COUNTS]
    order = sorted(range(24), key=lambda h: -al.HOURLY_COUNTS[h])
    for h in order[:100 - sum(floors)]:
        floors[h] += 1
    assert full["c"] == floors


def test_uniform_profile(spark):
    empty = spark.createDataFrame([], "hour int, n long")
    rows = al.hourly_fractions(empty).collect()
    assert len(rows) == 24 and all(r["fraction"] == pytest.approx(1 / 24) for r in rows)
    d = spark.createDataFrame([("a", 24)], "loc string, officers_assigned int")
    for profile in (al.hour_profile([0] * 24), al.profile_of(al.hourly_fractions(empty))):
        assert al.allocate_hourly_remainder(d, profile).first()["hourly"] == [1] * 24


def test_nest_and_flatten_are_inverse(spark):
    a = areas(spark, [("A1", "x"), ("A1", "y"), ("A2", "z"), ("B1", "q")])
    for size in (1, 5000):
        nested = tree.nest_hierarchy(a, max_areas=size)
        flat = tree.flatten_tree(nested).select(*tree.AREA_COLUMNS)
        assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, a.collect()))
    assert tree.nest_hierarchy(a).count() == 2


def test_tree_rows_are_bounded_by_their_content(spark):
    """a borough with few areas of much content was one row of any size."""
    a = areas(spark, [("A1" if i % 2 else "A2", f"c{i}") for i in range(60)] + [("B1", "q")])
    months = [f"{y}-{m:02d}" for y in range(2000, 2008) for m in range(1, 13)]
    empty = spark.createDataFrame([], "loc string, historical map<string,bigint>")
    wanted = scores(spark, [("c1", "2000-01", 2.0), ("q", "2000-02", 1.0)])
    whole = plan.integrated_tree(a, wanted, empty, months)
    assert whole.count() == 2
    full = tree.flatten_tree(whole).select(*tree.AREA_COLUMNS, "entry.predictions", "entry.historical",
                                           "entry.officer_assignments")
    payload = ["predictions", "historical", "officer_assignments"]
    nested = tree.nest_hierarchy(full, payload, max_cells=20_000)  # an area has 96 * (1 + 1 + 24) values
    sizes = [len(w["lsoas"]) for r in nested.collect() for lad in r["tree"].values() for w in lad["wards"].values()]
    assert nested.filter("lad = 'LA'").count() >= 6 and sum(sizes) == 61 and max(sizes) < 25
    back = tree.flatten_tree(nested).select(*tree.AREA_COLUMNS, *[F.col(f"entry.{c}") for c in payload])
    text = lambda d: sorted(r["j"] for r in d.select(F.to_json(F.struct(*d.columns)).alias("j")).collect())
    assert text(back) == text(full) and back.count() == 61
    assert back.agg(F.min(F.size("officer_assignments.hourly"))).first()[0] == 96


def test_points_of_a_hot_location_are_spread_and_kept(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("loc"), F.lit("2020-01").alias("month"),
        F.when(F.col("id") < 1200, 0.0).otherwise(F.col("id").cast("double")).alias("lon"), F.lit(51.0).alias("lat"))
    rows = tree.nest_points(df, "loc", "month", "lon", "lat", max_points=100).collect()
    hot = [r for r in rows if r["loc"] == "hot"]
    assert len(hot) > 5 and {r["total_burglary_count"] for r in hot} == {1500}
    assert sum(len(v) for r in hot for v in r["burglaries_by_month"].values()) == 1500
    assert sum(len(v) for r in rows for v in r["burglaries_by_month"].values()) == 2000
    assert max(len(v) for r in hot for v in r["burglaries_by_month"].values()) < 700


def test_integrated_tree_round_trip(spark, tmp_path):
    a = areas(spark, [("A1", "x"), ("A1", "y")])
    history = spark.createDataFrame([("x", 2024, 12, 3)], "loc string, year int, month int, n long")
    nested = plan.integrated_tree(a, scores(spark, [("x", "2025-01", 1.5)]),
                                  tree.history_by_location(history, "loc", "n"), ["2025-01", "2025-02"])
    path = str(tmp_path / "tree")
    sinks.write_json_tree(nested, path)
    line = json.loads(spark.read.text(path).first()["value"])
    x, y = (line["LA"]["wards"]["A1"]["lsoas"][k] for k in "xy")
    assert x["predictions"] == {"2025-01": 1.5} and x["historical"] == {"2024-12": 3}
    assert x["officer_assignments"]["daily"] == {"2025-01": 100, "2025-02": 0}
    assert sum(x["officer_assignments"]["hourly"]["2025-01"]) == 100
    assert "predictions" not in y and y["historical"] == {}
    back = {r["loc"]: r["entry"] for r in tree.flatten_tree(readers.read_json_tree(spark, path)).collect()}
    assert back["x"]["officer_assignments"]["hourly"]["2025-02"] == [0] * 24


def test_whole_document_is_read_too(spark, tmp_path):
    doc = {"L": {"name": "Lad", "wards": {"W": {"name": "Ward", "lsoas": {"c": {"name": "C", "predictions": {"2025-01": 2.0}}}}}}}
    (tmp_path / "doc.json").write_text(json.dumps(doc, indent=2))
    got = readers.read_json_tree(spark, [str(tmp_path / "none.json"), str(tmp_path / "doc.json")], document=True)
    row = tree.flatten_tree(got).first()
    assert (row["lad"], row["ward_name"], row["loc"], row["entry"]["predictions"]) == ("L", "Ward", "c", {"2025-01": 2.0})
    with pytest.raises(FileNotFoundError):
        readers.read_json_tree(spark, str(tmp_path / "none.json"))


def test_timeline_and_flags(spark):
    history = spark.createDataFrame([("a", "2024-11", 1), ("a", "2024-12", 2), ("b", "2024-12", 9)],
                                    "loc string, m string, historical long")
    preds = spark.createDataFrame([("a", "2025-01", 1.5), ("c", "2025-01", 2.5)], "loc string, m string, prediction double")
    rows = dash.merged_timeline(history, preds, "loc", "m").collect()
    assert [(r["loc"], r["m"], r["historical"], r["prediction"], r["prediction_start"]) for r in rows] == [
        ("a", "2024-11", 1, None, "2025-01"), ("a", "2024-12", 2, None, "2025-01"),
        ("a", "2025-01", None, 1.5, "2025-01"), ("c", "2025-01", None, 2.5, None)]
    a = spark.createDataFrame([("a",), ("z",)], "loc string")
    flags = {r["loc"]: tuple(r)[1:] for r in dash.area_flags(a, preds, history, preds).collect()}
    assert flags == {"a": (True, True, True), "z": (False, False, False)}
    roster = spark.createDataFrame([("a", "2025-01", [1] * 24), ("a", "2025-02", [1] * 23)],
                                   "loc string, m string, hourly array<int>")
    assert dash.officers_by_hour(roster, "loc", "m", code="a").count() == 24
    assert dash.points_in_range(history, "m", "2024-12").count() == 3
    assert dash.points_in_range(history, "m", "2024-12", "2024-12", "loc", "a").count() == 1


def test_roster_files(spark, tmp_path):
    a = areas(spark, [("A1", "x"), ("A1", "y")])
    daily = plan.daily_roster(a, scores(spark, [("x", "2025-01", 1.5)]), ["2025-01"])
    plan.export_rosters(daily, al.hour_profile(), str(tmp_path / "d"), str(tmp_path / "h"))
    d = spark.read.option("header", True).csv(str(tmp_path / "d"))
    h = spark.read.option("header", True).csv(str(tmp_path / "h"))
    assert d.columns == ["borough_code", "borough_name", "ward_code", "ward_name", "lsoa_code", "lsoa_name",
                         "prediction_score", "officers_assigned"]
    assert h.columns == d.columns[:-1] + ["hour_block", "officers_assigned"]
    assert d.count() == 2 and h.count() == 48


def test_nested_points_are_dealt_out_by_the_events(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    df = spark.range(2000).select((F.col("id") % 400).alias("loc"), F.lit("2020-01").alias("month"),
                                  F.col("id").cast("double").alias("lon"), F.lit(51.0).alias("lat"))
    parts = tree.nest_points(df, "loc", "month", "lon", "lat").groupBy(F.spark_partition_id()).agg(
        F.sum(F.size(F.col("burglaries_by_month")["2020-01"])).alias("n")).collect()
    assert sum(r["n"] for r in parts) == 2000 and max(r["n"] for r in parts) <= 400


def test_point_filter_deals_rows_out_by_their_number(spark, monkeypatch):
    """F16: the tasks that filter and group the points were merged to few large ones."""
    from arealis.operators import cleaning

    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    df = spark.range(4000).select(
        F.when(F.col("id") % 401 != 400, F.col("id") % 401).alias("loc"), F.lit("2020-01").alias("ym"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("lon"), F.lit(51.0).alias("lat"))
    allowed = spark.range(0, 400, 2).select(F.col("id").alias("loc"), F.lit(1).alias("other"))
    kept = cleaning.filter_nonnull_points(df, allowed.unionByName(allowed), "loc", "lon", "lat", "ym")
    grouped = kept.groupBy("loc", "ym", "lon", "lat").agg(F.count("*").alias("n"))
    parts = [r["n"] for r in grouped.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    want = [i for i in range(4000) if i % 401 != 400 and i % 401 % 2 == 0 and i % 7]
    assert sum(parts) == len(want) and max(parts) <= 400
    assert sorted(int(r["lon"]) for r in kept.collect()) == want
