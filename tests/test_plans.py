"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

import registry
from arealis.operators import cleaning, spatial, temporal
from registry import standins

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_stage_has_one_shuffle(spark):
    panel = spark.range(1000).selectExpr("id % 10 AS loc", "cast(id as int) AS year", "1 AS month", "id AS n")
    plan = physical(temporal.add_temporal_features(panel, "loc", "n", risk=True))
    assert plan.count("Exchange hashpartitioning") == 1 and len(re.findall(r"\bSort \[", plan)) == 2


def exchanges(node) -> list[str]:
    """Partitionings of the shuffles of a plan, without its subqueries."""
    if "AdaptiveSparkPlan" in node.nodeName():
        return exchanges(node.initialPlan())
    own = [node.outputPartitioning().toString()] if node.nodeName() == "Exchange" else []
    return own + [k for i in range(node.children().size()) for k in exchanges(node.children().apply(i))]


def test_grid_needs_no_join_and_feeds_the_windows(spark):
    df = temporal.add_temporal_features(standins.panel(spark, SF), "loc", "x")
    assert "Join" not in physical(df)
    # Without the subqueries (bounds and axis): the counts by location and month, then one
    # shuffle that collects the months of each location. The grid and all windows stay in it.
    keys = [k for k in exchanges(df._jdf.queryExecution().executedPlan()) if k.startswith("hashpartitioning(loc")]
    assert len([k for k in keys if k.count("#") == 1]) == 1 and len(keys) <= 2


def test_first_row_is_limited_before_the_shuffle(spark):
    d = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    assert physical(cleaning.dedup_first(d, ["k"])).count("WindowGroupLimit") == 2


def candidate_pairs(df) -> int:
    """Greatest number of rows that a join or an explode of the executed plan has made."""
    def walk(node):
        metrics = node.metrics()
        own = metrics.apply("numOutputRows").value() if metrics.contains("numOutputRows") else 0
        below = [walk(node.children().apply(i)) for i in range(node.children().size())]
        if "AdaptiveSparkPlan" in node.nodeName():
            below.append(walk(node.executedPlan()))
        elif "QueryStage" in node.nodeName():
            below.append(walk(node.plan()))
        counts = own if any(w in node.nodeName() for w in ("Join", "Generate")) else 0
        return max([counts, *below])
    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("name", [
    "densify_grid", "temporal_features", "feature_table", "neighbor_features", "allocate_daily", "integrate_all",
    "collect_events", "population_join", "snapshot_join", "extrapolate_years", "forecast_months", "nest_points",
    "colocated_points", "nearest_station", "nearest_station_divided", "merged_timeline"])
def test_no_cross_product_and_no_python(spark, name):
    plan = physical(registry.QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan, bad


def test_scan_reads_only_needed_columns(spark):
    plan = physical(registry.QUERIES["count_by_loc_month"](spark, SF))
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp(_ntz)?>", plan)


def test_key_filter_reaches_the_scan(spark, tmp_path):
    from arealis.operators import dashboard

    path = str(tmp_path / "series")
    spark.range(100).selectExpr("id AS loc", "'2020-01' AS m", "id AS v").write.parquet(path)
    plan = physical(dashboard.points_in_range(spark.read.parquet(path), "m", "2020-01", "2020-02", "loc", 5))
    assert "EqualTo(loc,5)" in plan and "GreaterThanOrEqual(m,2020-01)" in plan


def test_edges_are_not_all_pairs(spark):
    """The divided search compares each query with few cells, not with every target."""
    points = spark.range(3000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    df = spatial.knn_edges(points, "id", "x", "y", small=0)
    plan = physical(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    df.collect()
    joined = df._jdf.queryExecution().executedPlan()
    text = joined.toString()
    assert "SortMergeJoin" in text or "HashJoin" in text
    # Pairs of a query and a target that reach the last ranking.
    assert candidate_pairs(df) < 3000 * 300
