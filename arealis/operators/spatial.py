"""Nearest neighbours, neighbourhood features and point grouping."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import geo
from ..functions.scalars import let
from ..session import cut_lineage
from .skew import TASK_ROWS, is_small, numbered_rows, task_count

#: Places that a leaf of the split tree holds about; parts that one level cuts a cell into at most.
LEAF, PARTS = 32, 256


def nearest(queries: DataFrame, query_axes: Sequence[Column], targets: DataFrame,
            target_axes: Sequence[Column], target_key: str, k: int, *,
            leaf_size: int = LEAF, small: int = 1000) -> DataFrame:
    """The k nearest targets of every distinct query position, exactly.

    Returns the distinct positions of ``queries`` as columns ``_q0.._qd`` with
    ``neighbor``, ``_d`` (straight-line distance) and ``rank`` 1..k; ties go to the
    smaller key.

    Equal positions are collapsed first, on both sides: however many copies a place
    has, it is searched once, and it offers its k smallest keys. The distinct places
    are then divided by a split tree (see ``split_tree``). A query is looked up in the
    tree by arithmetic; the places of its own leaf give a distance within which k
    targets are certain, and one more pass compares it with every leaf that reaches into
    that distance. A leaf travels as one row, so no query meets more than a few leaves,
    and no cross join is needed.
    """
    axes = range(len(query_axes))
    q = [f"_q{i}" for i in axes]
    t = [f"_t{i}" for i in axes]

    places = _finite(targets.select(
        *[c.cast("double").alias(n) for c, n in zip(target_axes, t)],
        F.col(target_key).alias("_key")), t)
    by_place = Window.partitionBy(*t).orderBy("_key")
    few = places.withColumn("_rn", F.row_number().over(by_place)).filter(F.col("_rn") <= k)
    spots = _finite(queries.select(*[c.cast("double").alias(n) for c, n in zip(query_axes, q)]), q)

    if is_small(few, small):
        return _nearest_in_row(spots.distinct(), q, few, t, k)

    sites = cut_lineage(few.groupBy(*t).agg(F.sort_array(F.collect_list("_key")).alias("_keys")))
    levels, leaves = split_tree(sites, t, leaf_size)
    pairs = _near_leaves(spots.distinct(), q, levels, leaves, t, k)
    found = pairs.join(leaves.select("_cell", "_sites"), "_cell")
    # The k best of a leaf can be among the k best of all, the others cannot.
    keyed = F.flatten(F.transform("_sites", lambda s: F.transform(s["_keys"], lambda key: F.struct(
        F.sqrt(_gap(q, t, s)).alias("_d"), key.alias("neighbor")))))
    found = found.select(*q, F.explode(F.slice(F.array_sort(keyed), 1, k)).alias("_e")).select(
        *q, "_e._d", "_e.neighbor")
    order = Window.partitionBy(*q).orderBy("_d", "neighbor")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf")))
    return df


def tree_shape(places: int, axes: int, leaf_size: int) -> tuple[int, int]:
    """Levels of the split tree and parts of a level, for leaves of about ``leaf_size`` places.

    As many levels as axes where that needs no more than ``PARTS`` parts a level, so that
    leaves are about as long as wide; one where two or three leaves will do.
    """
    wanted = max(1, math.ceil(places / leaf_size))
    levels = 1 if wanted <= 4 else max(axes, math.ceil(math.log(wanted) / math.log(PARTS)))
    return levels, max(2, math.ceil(wanted ** (1 / levels) - 1e-9))


def split_tree(sites: DataFrame, t: Sequence[str], leaf_size: int = LEAF) -> tuple[list[DataFrame], DataFrame]:
    """Levels and leaves of a balanced tree over ``sites`` (distinct places ``t`` with their ``_keys``).

    A level divides each of its cells by counted quantiles of the places (mergeable
    sketches, one aggregate a level), along the axis on which these quantiles part the
    places best. Parts hold equal numbers of places, not equal room: the depth depends on
    the number of places only, however they lie, and is the same everywhere. A level has
    a row per cell: ``_cell``, ``_axis``, ``_cuts`` (ascending), ``_n`` (targets) and the
    bounding box ``_lo0, _hi0, ..``; part p of a cell is cell * parts + p. A leaf has
    ``_cell``, ``_n``, the box and its places as the array ``_sites``.
    """
    axes = range(len(t))
    count, parts = tree_shape(sites.count(), len(t), leaf_size)
    shares = [i / parts for i in range(1, parts)]
    box = [f for i, c in enumerate(t) for f in (F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}"))]
    size = F.sum(F.size("_keys")).alias("_n")
    placed, levels = sites.withColumn("_cell", F.lit(0).cast("bigint")), []
    for _ in range(count):
        stats = placed.groupBy("_cell").agg(size, *box, *[
            F.array_distinct(F.percentile_approx(c, shares, 100 * parts)).alias(f"_cuts{i}") for i, c in enumerate(t)])
        # Most different cuts first, then the longest side.
        best = F.array_max(F.array(*[F.struct(
            F.size(_inner_cuts(i)).alias("parted"), (F.col(f"_hi{i}") / 2 - F.col(f"_lo{i}") / 2).alias("side"),
            F.lit(i).alias("axis"), _inner_cuts(i).alias("cuts")) for i in axes]))
        level = cut_lineage(stats.withColumn("_best", best).select(
            "_cell", "_n", *[f"_{end}{i}" for i in axes for end in ("lo", "hi")],
            F.col("_best.axis").alias("_axis"), F.col("_best.cuts").alias("_cuts")))
        levels.append(level)
        at = _along(t)
        placed = placed.join(level.select("_cell", "_axis", "_cuts"), "_cell").select(
            *t, "_keys", _part(F.col("_cell"), parts, at).alias("_cell"))
    leaves = cut_lineage(placed.groupBy("_cell").agg(size, *box, F.collect_list(F.struct(*t, "_keys")).alias("_sites")))
    return [level.withColumn("_parts", F.lit(parts)) for level in levels], leaves


def _inner_cuts(axis: int) -> Column:
    """Cuts that leave something below them."""
    return F.filter(f"_cuts{axis}", lambda c: c > F.col(f"_lo{axis}"))


def _along(columns: Sequence[str | Column]) -> Column:
    """The coordinate on the axis that the cell is cut along."""
    return F.get(F.array(*[F.col(c) if isinstance(c, str) else c for c in columns]), F.col("_axis"))


def _part(cell: Column, parts: int | Column, at: Column) -> Column:
    return cell * parts + let(at, lambda x: F.size(F.filter("_cuts", lambda c: c <= x)))


def _gap(q: Sequence[str], t: Sequence[str], site: Column) -> Column:
    return _sum([_square(F.col(a) - site[b]) for a, b in zip(q, t)])


def _box_gap(q: Sequence[str], far: bool = False) -> Column:
    """Square of the distance from a query to its nearest (or farthest) place in a box."""
    pick = [(F.col(f"_lo{i}") - F.col(c), F.col(c) - F.col(f"_hi{i}")) for i, c in enumerate(q)]
    return _sum([_square(F.greatest(F.abs(a), F.abs(b)) if far else F.greatest(a, b, F.lit(0.0))) for a, b in pick])


def _near_leaves(spots: DataFrame, q: Sequence[str], levels: Sequence[DataFrame], leaves: DataFrame,
                 t: Sequence[str], k: int) -> DataFrame:
    """(query, _cell) for every leaf that can hold one of the query's k nearest targets."""
    axes = range(len(q))
    # First pass: the own leaf. A cell of k targets bounds the distance by its farthest corner.
    own = spots.withColumns({"_cell": F.lit(0).cast("bigint"), "_reach": F.lit(float("inf"))})
    for level in levels:
        inside = [F.greatest(F.least(F.col(c), F.col(f"_hi{i}")), F.col(f"_lo{i}")) for i, c in enumerate(q)]
        own = own.join(level, "_cell").select(
            *q, _part(F.col("_cell"), F.col("_parts"), _along(inside)).alias("_cell"),
            F.least("_reach", F.when(F.col("_n") >= k, _box_gap(q, far=True))).alias("_reach"))
    nearby = F.element_at(F.slice(F.array_sort(F.transform("_sites", lambda s: _gap(q, t, s))), k, 1), 1)
    own = own.join(leaves.select("_cell", "_sites"), "_cell").select(
        *q, F.least("_reach", F.when(F.size("_sites") >= k, nearby)).alias("_reach"))
    # Second pass: in each level the parts between the distance to the left and to the right.
    pairs = cut_lineage(own.withColumn("_cell", F.lit(0).cast("bigint")))
    near = (_box_gap(q) <= F.col("_reach") * (1 + 1e-9))
    for level in levels:
        wide = F.sqrt("_reach") * (1 + 1e-9)
        pairs = pairs.join(level, "_cell").filter(near)
        low, high = (F.size(F.filter("_cuts", lambda c: c <= F.col("_edge")[end])) for end in ("a", "b"))
        at = _along(q)
        pairs = pairs.withColumn("_edge", F.struct((at - wide).alias("a"), (at + wide).alias("b"))).select(
            *q, "_reach", F.explode(F.transform(F.sequence(low, high), lambda p: (
                F.col("_cell") * F.col("_parts") + p))).alias("_cell"))
    return pairs.join(leaves.select("_cell", *[f"_{end}{i}" for i in axes for end in ("lo", "hi")]), "_cell").filter(
        near).select(*q, "_cell")


def _nearest_in_row(spots: DataFrame, q: Sequence[str], few: DataFrame, t: Sequence[str],
                    k: int) -> DataFrame:
    """Same result for a counted, small target set carried as one array."""
    posts = few.select(F.collect_list(F.struct(*t, "_key"))).scalar()
    ordered = F.array_sort(F.transform("_posts", lambda s: F.struct(
        F.sqrt(_sum([_square(F.col(q[i]) - s[t[i]]) for i in range(len(q))])).alias("_d"),
        s["_key"].alias("neighbor"))))
    return (spots.withColumn("_posts", posts).select(*q, F.posexplode(F.slice(ordered, 1, k)).alias("_pos", "_e"))
            .select(*q, "_e._d", "_e.neighbor", (F.col("_pos") + 1).alias("rank")))


def _square(c: Column) -> Column:
    return c * c


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def knn_edges(points: DataFrame, key: str, x: str, y: str, k: int = 5, *,
              small: int = 1000) -> DataFrame:
    """k nearest other points in the plane: (location, neighbor, distance, rank).

    One neighbour more than asked is searched per place; the point itself is then
    removed by its key, not by its position in the list.
    """
    found = nearest(points, [F.col(x), F.col(y)], points, [F.col(x), F.col(y)], key, k + 1,
                    small=small)
    lists = found.groupBy("_q0", "_q1").agg(F.array_sort(F.collect_list(
        F.struct("rank", "neighbor", F.col("_d").alias("distance")))).alias("_found"))
    own = points.select(F.col(key).alias("location"), F.col(x).cast("double").alias("_q0"),
                        F.col(y).cast("double").alias("_q1"))
    others = F.filter("_found", lambda e: e["neighbor"] != F.col("location"))
    return (own.join(lists, ["_q0", "_q1"])
            .select("location", F.posexplode(F.slice(others, 1, k)).alias("_pos", "_e"))
            .select("location", F.col("_e.neighbor").alias("neighbor"),
                    F.col("_e.distance").alias("distance"),
                    (F.col("_pos") + 1).alias("neighbor_rank")))


def nearest_station(points: DataFrame, lat: str, lon: str, stations: DataFrame, station: str,
                    station_lat: str, station_lon: str, *, small: int = 1000) -> DataFrame:
    """Nearest station of every point and its great-circle distance in metres.

    The search runs on the unit sphere, where the straight-line order equals the
    great-circle order. A station is its name and its place together: the same name at
    two places is two stations, and ties go to the smaller name, then place. Points
    without a finite position get NULL, stations without one are left out. ``small``
    (see ``nearest``) chooses the plan, not the result.
    """
    located = stations.select(F.struct(
        F.col(station).alias("k"), F.col(station_lat).cast("double").alias("a"),
        F.col(station_lon).cast("double").alias("o")).alias("post"))
    places = _finite(points.select(F.col(lat).cast("double").alias("_a"),
                                   F.col(lon).cast("double").alias("_o")), ["_a", "_o"]).distinct()
    axes = geo.unit_sphere(F.col("_a"), F.col("_o"))
    placed = places.withColumns({f"_q{i}": axes[i] for i in range(3)})
    hit = placed.join(nearest(places, axes, located, geo.unit_sphere(F.col("post.a"), F.col("post.o")),
                              "post", 1, small=small), ["_q0", "_q1", "_q2"])
    found = hit.select("_a", "_o", F.col("neighbor.k").alias("nearest_station"), geo.haversine_m(
        F.col("_a"), F.col("_o"), F.col("neighbor.a"), F.col("neighbor.o")).alias("distance_m"))
    return points.join(found, (points[lat].cast("double") == found["_a"])
                       & (points[lon].cast("double") == found["_o"]), "left").drop("_a", "_o")


def neighbor_self_join(panel: DataFrame, edges: DataFrame, location: str, target: str) -> DataFrame:
    """Panel rows with each neighbour's count of the same month (NULL where absent).

    Rows of locations without neighbours, often most of the panel, take no part in the join:
    their empty key would bring each month of them to one task. A written panel takes about a
    byte a row: by its size the optimiser would bring millions of rows to the driver to send
    them out, so the joins are merged, that with the edges where a count shows that they are many.
    """
    panel = cut_lineage(panel)
    links = edges.select(F.col("location").alias(location), "neighbor", "distance", "neighbor_rank")
    if not is_small(links, TASK_ROWS):
        links = links.hint("merge")
    other = panel.select(F.col(location).alias("neighbor"), "year", "month",
                         F.col(target).alias(f"{target}_neighbor"))
    linked = panel.join(links, location)
    tasks = task_count(panel.sparkSession, panel.count() + linked.count())
    keys = ["neighbor", "year", "month"]
    found = linked.repartition(tasks, *keys).join(other.hint("merge"), keys, "left")
    alone = panel.join(links, location, "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)


def add_neighbor_features(panel: DataFrame, edges: DataFrame, location: str = "loc",
                          target: str = "count", prefix: str = "neighbor", *,
                          only_present: bool = False, hub: int = 10_000) -> DataFrame:
    """Mean, maximum, deviation, inverse-distance mean and nearest count of the
    neighbours in the same month.

    The weighted mean divides by the weights of all neighbours, also of those
    without a row that month (``only_present=True`` uses the present ones only).
    That denominator depends on the location alone and comes from the edge list, so
    the panel is expanded over the edges once and aggregated right away; the
    location's own row is not needed in the expansion.

    A place with very many copies makes a few locations the neighbour of all of them.
    The edges to a location with more than ``hub`` of them are spread over salts, and
    its few panel rows are repeated once per salt.
    """
    weight = 1 / (F.col("distance") + 100)
    links = edges.select(F.col("location").alias("_to"), F.col("neighbor").alias(location),
                         "distance", "neighbor_rank")
    counts = panel.select(location, "year", "month", F.col(target).alias("_c"))
    hubs = links.groupBy(location).agg(F.count("*").alias("_in")).filter(F.col("_in") > hub).select(
        location, F.ceil(F.col("_in") / hub).cast("int").alias("_parts"))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    links = links.join(hubs, location, "left").withColumn(
        "_salt", F.pmod(F.xxhash64("_to"), parts).cast("int")).drop("_parts")
    counts = counts.join(hubs, location, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    seen = counts.join(links, [location, "_salt"])
    stats = seen.groupBy(F.col("_to").alias(location), "year", "month").agg(
        F.avg("_c").alias(f"{prefix}_avg"),
        F.max("_c").alias(f"{prefix}_max"),
        F.stddev_samp("_c").alias(f"{prefix}_std"),
        F.sum(F.col("_c") / (F.col("distance") + 100)).alias("_weighted"),
        F.sum(F.when(F.col("_c").isNotNull(), weight)).alias("_present"),
        F.max(F.when(F.col("neighbor_rank") == 1, F.col("_c"))).alias(f"closest_{prefix}"))
    totals = edges.groupBy(F.col("location").alias(location)).agg(F.sum(weight).alias("_all"))
    joined = panel.join(stats, [location, "year", "month"], "left").join(totals, location, "left")
    below = F.col("_present") if only_present else F.col("_all")
    return joined.withColumn(
        f"{prefix}_weighted_avg", F.try_divide(F.coalesce("_weighted", F.lit(0.0)), below)
    ).drop("_weighted", "_present", "_all")


def distance_histogram(df: DataFrame, value: str, bins: int = 200) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum; the last bin is closed."""
    bounds = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("b")).scalar()
    width = (bounds["hi"] - bounds["lo"]) / bins
    at = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col(value) - bounds["lo"], width)), F.lit(bins - 1)))
    return (df.filter(F.col(value).isNotNull()).groupBy(at.cast("int").alias("bin"))
            .agg(F.count("*").alias("n")))


def colocated_points(df: DataFrame, lat: str, lon: str, order: str, digits: int = 6) -> DataFrame:
    """Rounded place, ordinal of the point at its place, and the size of the place.

    ``order`` is a unique number; a place with very many points is numbered in
    parallel (see ``numbered_rows``).
    """
    rounded = df.withColumns({"place_lat": F.round(F.col(lat), digits),
                              "place_lon": F.round(F.col(lon), digits)})
    return numbered_rows(rounded, ["place_lat", "place_lon"], order, "ordinal", "place_size")
