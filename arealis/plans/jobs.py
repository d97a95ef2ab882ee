"""Command-line jobs: files in, files out.

    python -m arealis.plans.jobs collect --events DIR --lookup P --out P [--kind Burglary]
    ... lookup --files A B C --out P [--prefix E09]
    ... neighbors --centroids CSV --out P
    ... dataset --events P --out DIR [--population P] [--imd P P P] [--housing P] [--edges P] [--classes CSV]
    ... forecast --model DIR --features P --lookup P --start YYYY-MM --end YYYY-MM --out DIR
    ... rosters --predictions DIR --history P --months YYYY-MM ... --out DIR
    ... train --features P --model DIR --report DIR [--trials N] [--objectives O ...] [--columns C ...]
    ... csv-rosters --predictions DIR --months YYYY-MM ... --out DIR
    ... deprivation --files 2010 2015 2019 --lookup P --out DIR
    ... housing --dwellings CSV --lookup P --out P
    ... residential --cover CSV --lookup P --out DIR
    ... points --events P --lookup P --classes CSV --out DIR --report DIR

On a cluster set spark.checkpoint.dir to a folder that all executors share.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import calendar as cal
from ..operators import allocate, cleaning, lookup, model, spatial, tree
from ..operators.demographics import classify_locations, land_use_class, population_long
from ..session import cut_lineage, job_session, remove_tables, tables_written
from ..sources import readers, schemas, sinks
from . import roster
from .feature_table import build_features

LOCATION = "LSOA code"
TARGET = "burglary_count"


def collect(spark: SparkSession, events: str, lookup_path: str, out: str, kind: str = "Burglary") -> None:
    """Raw monthly extracts -> one table of recoded, valid, distinct events."""
    areas = readers.to_dataframe(spark, lookup_path)
    sinks.write_parquet(lookup.collect_events(readers.read_events(spark, events), areas, kind=kind), out)


def area_lookup(spark: SparkSession, files: Sequence[str], out: str, prefix: str | None = None) -> None:
    """Three lookup files -> one area table, optionally of one region's codes."""
    frames = [readers.scan_lookup(spark, path, columns)
              for path, columns in zip(files, schemas.LOOKUP_FILES, strict=True)]
    where = None if prefix is None else F.col("LAD22CD").startswith(prefix)
    sinks.write_parquet(lookup.build_lookup(frames, "LSOA21CD", schemas.AREA_LOOKUP.names, where), out)


def deprivation(spark: SparkSession, files: Sequence[str], lookup_path: str, out: str) -> None:
    """The three deprivation tables (CSV or Parquet) -> ``imd_<year>.parquet`` per current area code.

    Columns are taken by position and get the headers of the middle version; scores of
    old codes are averaged per current code, and every current code has a row.
    """
    areas = readers.to_dataframe(spark, lookup_path)
    headers = {2010: schemas.IMD_2010_HEADERS, 2019: schemas.IMD_2019_HEADERS}
    key, *scores = schemas.IMD_COLUMNS
    for path, year in zip(files, sorted(schemas.IMD_YEARS), strict=True):
        table = cleaning.harmonise_columns(readers.read_table(spark, path), schemas.IMD_POSITIONS[year],
                                           headers.get(year), schemas.IMD_COLUMNS)
        numbers = table.select(F.col(f"`{key}`"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in scores])
        sinks.write_parquet(lookup.recode_average(numbers, areas, key, "LSOA11CD", "LSOA21CD", LOCATION),
                            f"{out}/imd_{year}.parquet")


def housing(spark: SparkSession, dwellings: str, lookup_path: str, out: str) -> None:
    """Dwelling stock by band -> dwelling counts of the areas of the lookup."""
    clean = cleaning.clean_numeric(readers.read_table(spark, dwellings), schemas.HOUSING_TEXT)
    sinks.write_parquet(cleaning.housing_extract(clean, readers.to_dataframe(spark, lookup_path), "LSOA21CD",
                                                 out_key=LOCATION), out)


def residential(spark: SparkSession, cover: str, lookup_path: str, out: str) -> None:
    """Land cover -> ``percent`` (all areas) and ``classification`` (areas of the lookup), as CSV."""
    land = readers.read_table(spark, cover)
    share = ["residential_pct_2018"]
    sinks.write_csv(land_use_class(land, schemas.RESIDENTIAL_COLUMNS).select("LSOA11CD", "LSOA11NM", *share),
                    f"{out}/percent")
    known = classify_locations(land, readers.to_dataframe(spark, lookup_path), schemas.RESIDENTIAL_COLUMNS,
                               "LSOA11CD", "LSOA21CD")
    sinks.write_csv(known.select("LSOA11CD", "LSOA21CD", "LSOA11NM", *share, "is_residential_dominant",
                                 "residential_advantage"), f"{out}/classification")


def points(spark: SparkSession, events: str, lookup_path: str, classes: str, out: str, report: str) -> None:
    """Events of residential areas -> tree with the points of every month, and a summary table.

    Areas are those that occur in the events and are mainly residential; events without a
    place or a month are left out, areas keep their entry without them.
    """
    rows = readers.to_dataframe(spark, events)
    flags = readers.scan_lookup(spark, classes, ["LSOA21CD", "is_residential_dominant"]).withColumn(
        "is_residential_dominant", F.col("is_residential_dominant").cast("boolean"))
    allowed = cut_lineage(lookup.allowed_locations(rows.withColumnRenamed(LOCATION, "loc"), "loc", flags, "LSOA21CD"))
    areas = tree.area_table(_areas(spark, lookup_path), allowed)
    used = cleaning.filter_nonnull_points(rows.withColumnRenamed(LOCATION, "loc"), areas, "loc", "Longitude",
                                          "Latitude", "Month").select("loc", "Month", "Longitude", "Latitude")
    used = cut_lineage(used)
    nested = tree.attach(areas, tree.nest_points(used, "loc", "Month", "Longitude", "Latitude"))
    fields = {f.name: f.dataType for f in tree.entry_schema().fields}
    empty = {"burglaries_by_month": F.create_map(), "total_burglary_count": F.lit(0), "months_with_data": F.array()}
    filled = nested.withColumns({c: F.coalesce(F.col(c), value.cast(fields[c])) for c, value in empty.items()})
    sinks.write_json_tree(tree.nest_hierarchy(filled, list(empty), split="part"), out)
    sinks.write_csv(tree.tree_summary(used.join(areas.select("lad", "loc"), "loc"), "lad", "loc", "Month"), report)


def neighbors(spark: SparkSession, centroids: str, out: str, k: int = 5) -> None:
    points = readers.scan_lookup(spark, centroids, ["LSOA21CD", "x", "y"])
    edges = spatial.knn_edges(points.withColumns({c: F.col(c).cast("double") for c in ("x", "y")}),
                              "LSOA21CD", "x", "y", k)
    sinks.write_parquet(edges, out)


def dataset(spark: SparkSession, events: str, out: str, population: str | None = None,
            imd: Sequence[str] = (), housing: str | None = None, edges: str | None = None,
            classes: str | None = None) -> None:
    """Events and dimensions -> ``features`` and the split into X/y, train/test.

    The table is computed once; the four split files are read from it. y keeps the
    row keys.
    """
    def keyed(path: str | None) -> DataFrame | None:
        if path is None:
            return None
        df = readers.to_dataframe(spark, path)
        return df.withColumnRenamed(readers.find_location(df), LOCATION)

    people, homes = keyed(population), keyed(housing)
    links = readers.to_dataframe(spark, edges) if edges else None
    if links is not None and "lsoa_code" in links.columns:
        links = links.withColumnsRenamed({"lsoa_code": "location", "neighbor_code": "neighbor"})
    flagged = None
    if classes:
        flagged = readers.scan_lookup(spark, classes, ["LSOA21CD", "is_residential_dominant"]).withColumn(
            "is_residential_dominant", F.col("is_residential_dominant").cast("boolean"))
    versions = lookup.version_union([
        (keyed(path), *schemas.IMD_YEARS[year]) for path, year in zip(imd, sorted(schemas.IMD_YEARS))
    ]) if imd else None
    table = build_features(
        readers.to_dataframe(spark, events).select(LOCATION, "Month"), location=LOCATION, target=TARGET,
        population=population_long(people, LOCATION) if people is not None else None,
        snapshots=versions, housing=homes.drop("AREA_NAME") if homes is not None else None,
        edges=links, classes=flagged, class_key="LSOA21CD", neighbor_prefix="neighbor_burglary")
    sinks.write_parquet(table, f"{out}/features.parquet")
    split = model.temporal_split(readers.to_dataframe(spark, f"{out}/features.parquet"))
    for part in ("train", "test"):
        x, y = model.features_and_target(split.filter(F.col("part") == part).drop("part"), TARGET,
                                         [LOCATION, "year", "month"])
        sinks.write_parquet(x, f"{out}/X_{part}.parquet")
        sinks.write_parquet(y, f"{out}/y_{part}.parquet")


def _areas(spark: SparkSession, path: str) -> DataFrame:
    names = {"LAD22CD": "lad", "LAD22NM": "lad_name", "WD24CD": "ward", "WD24NM": "ward_name",
             "LSOA21CD": "loc", "LSOA21NM": "loc_name"}
    return readers.to_dataframe(spark, path).withColumnsRenamed(names)


def forecast(spark: SparkSession, model_path: str, features: str, lookup_path: str, start: str, end: str,
             out: str) -> None:
    """Saved model and feature rows -> prediction tree of the forecast areas."""
    rows = readers.to_dataframe(spark, features)
    location = readers.find_location(rows)
    predicted = model.forecast_months(rows, location, start, end, model=PipelineModel.load(model_path))
    keyed = roster.keyed_predictions(predicted, location)
    areas = tree.area_table(_areas(spark, lookup_path), keyed)
    maps = tree.month_map(keyed, "loc", "month_key", "score", "predictions")
    sinks.write_json_tree(tree.nest_hierarchy(tree.attach(areas, maps), ["predictions"]), out)


def train(spark: SparkSession, features: str, model_path: str, report: str, trials: int = 30,
          objectives: Sequence[str] = ("squared_error", "poisson"), columns: Sequence[str] = ()) -> None:
    """Feature table -> tuned and fitted model, its scores, and the search table.

    Split by time, random search inside the training rows, the winner refitted on all of
    them, metrics on both parts. ``columns``: features; by default every numeric column
    but the target and the time of the split.
    """
    rows = readers.to_dataframe(spark, features)
    location = readers.find_location(rows)
    parts = model.temporal_split(rows)
    numeric = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)]
    names = list(columns) or [c for c in numeric if c not in (TARGET, location)]
    learn = cut_lineage(parts.filter("part = 'train'"))
    scores = cut_lineage(model.tune_random(learn, names, TARGET, [location, "year", "month"], trials=trials,
                                           objectives=tuple(objectives)))
    fitted = model.refit_best(learn, names, TARGET, scores)
    fitted.write().overwrite().save(model_path)
    done = model.clip_predictions(fitted.transform(parts))
    sinks.write_csv(model.regression_metrics(done, TARGET, "prediction", "part"), f"{report}/metrics")
    sinks.write_csv(scores, f"{report}/search")


def csv_rosters(spark: SparkSession, predictions: str | Sequence[str], months: Sequence[str], out: str) -> None:
    """Prediction tree -> daily and hourly roster files."""
    entry = T.StructType([f for f in tree.entry_schema().fields if f.name in ("name", "predictions")])
    flat = tree.flatten_tree(readers.read_json_tree(spark, predictions, entry))
    scores = flat.select("loc", F.explode("entry.predictions").alias("month_key", "score"))
    daily = roster.daily_roster(flat.select(*tree.AREA_COLUMNS), scores, months)
    roster.export_rosters(daily, allocate.hour_profile(), f"{out}/daily", f"{out}/hourly")


def rosters(spark: SparkSession, predictions: str | Sequence[str], history: str, months: Sequence[str],
            out: str) -> None:
    """Prediction tree and feature table -> tree with history and officer assignments."""
    entry = T.StructType([f for f in tree.entry_schema().fields if f.name in ("name", "predictions")])
    flat = tree.flatten_tree(readers.read_json_tree(spark, predictions, entry))
    areas = flat.select(*tree.AREA_COLUMNS)
    scores = flat.select("loc", F.explode("entry.predictions").alias("month_key", "score"))
    past = readers.to_dataframe(spark, history)
    counts = tree.history_by_location(past.withColumnRenamed(readers.find_location(past), "loc"), "loc", TARGET)
    sinks.write_json_tree(roster.integrated_tree(areas, scores, counts, months), out)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str, **optional):
        sub = jobs.add_parser(name)
        for arg in required:
            sub.add_argument(f"--{arg}", required=True)
        for arg, options in optional.items():
            sub.add_argument(f"--{arg}", **options)

    many = {"nargs": "+", "required": True}
    job("collect", "events", "lookup", "out", kind={"default": "Burglary"})
    job("lookup", "out", files={"nargs": 3, "required": True}, prefix={})
    job("neighbors", "centroids", "out", k={"type": int, "default": 5})
    job("dataset", "events", "out", population={}, imd={"nargs": 3, "default": ()}, housing={}, edges={}, classes={})
    job("forecast", "model", "features", "lookup", "start", "end", "out")
    job("rosters", "history", "out", predictions=many, months=many)
    job("train", "features", "model", "report", trials={"type": int, "default": 30},
        objectives={"nargs": "+", "default": ("squared_error", "poisson")}, columns={"nargs": "*", "default": ()})
    job("csv-rosters", "out", predictions=many, months=many)
    job("deprivation", "lookup", "out", files={"nargs": 3, "required": True})
    job("housing", "dwellings", "lookup", "out")
    job("residential", "cover", "lookup", "out")
    job("points", "events", "lookup", "classes", "out", "report")
    a = parser.parse_args(argv)
    if a.job == "forecast" and cal.parse_year_month(a.end) < cal.parse_year_month(a.start):
        parser.error("the last month must not precede the first month")
    spark, before = job_session(f"arealis-{a.job}"), tables_written()
    try:
        if a.job == "collect":
            collect(spark, a.events, a.lookup, a.out, a.kind)
        elif a.job == "lookup":
            area_lookup(spark, a.files, a.out, a.prefix)
        elif a.job == "neighbors":
            neighbors(spark, a.centroids, a.out, a.k)
        elif a.job == "dataset":
            dataset(spark, a.events, a.out, a.population, a.imd, a.housing, a.edges, a.classes)
        elif a.job == "forecast":
            forecast(spark, a.model, a.features, a.lookup, a.start, a.end, a.out)
        elif a.job == "train":
            train(spark, a.features, a.model, a.report, a.trials, a.objectives, a.columns)
        elif a.job == "csv-rosters":
            csv_rosters(spark, a.predictions, a.months, a.out)
        elif a.job == "deprivation":
            deprivation(spark, a.files, a.lookup, a.out)
        elif a.job == "housing":
            housing(spark, a.dwellings, a.lookup, a.out)
        elif a.job == "residential":
            residential(spark, a.cover, a.lookup, a.out)
        elif a.job == "points":
            points(spark, a.events, a.lookup, a.classes, a.out, a.report)
        else:
            rosters(spark, a.predictions, a.history, a.months, a.out)
    finally:
        remove_tables(spark, before)


if __name__ == "__main__":
    main()
