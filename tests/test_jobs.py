"""Command-line jobs from files to files on a tiny region."""

import json
import random

import pytest

from arealis.operators import model as m
from arealis.plans import jobs
from arealis.sources import schemas


@pytest.fixture(scope="module")
def region(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("region")
    codes = [f"E{i:02d}" for i in range(8)]
    (root / "oa.csv").write_text("OA21CD,LSOA21CD,LSOA21NM,MSOA21CD,MSOA21NM\n" + "\n".join(
        f"O{c},{c},Area {c},M1,Mid" for c in codes))
    (root / "lad.csv").write_text("LSOA21CD,LSOA11CD,CHGIND,LAD22CD,LAD22NM\n" + "\n".join(
        f"{c},{c},U,{'E09' if c < 'E06' else 'W01'},Lad" for c in codes))
    (root / "ward.csv").write_text("LSOA21CD,WD24CD,WD24NM\n" + "\n".join(
        f"{c},W{int(c[1:]) % 2},Ward {int(c[1:]) % 2}" for c in codes))
    (root / "pwc.csv").write_text("LSOA21CD,x,y\n" + "\n".join(f"{c},{int(c[1:]) ** 2},0" for c in codes))
    (root / "classes.csv").write_text("LSOA21CD,is_residential_dominant\n" + "\n".join(
        f"{c},{c != 'E01'}" for c in codes))
    rng = random.Random(1)
    head = ",".join(f.name for f in schemas.EVENTS.fields)
    n = 0
    for year in (2015, 2016, 2017):
        for month in range(1, 13):
            key = f"{year}-{month:02d}"
            folder = root / "raw" / key
            folder.mkdir(parents=True)
            lines = [head]
            for _ in range(12):
                n += 1
                c = rng.choice(codes)
                lines.append(f"id{n},{key},,,0.1,51.5,,{c},Area {c},{rng.choice(['Burglary', 'Drugs'])},,")
            (folder / f"{key}-city-street.csv").write_text("\n".join(lines))
    people = [(c, *[100 + i for i in range(2)], *[1.5 + i for i in range(2)]) for c in codes]
    spark.createDataFrame(people, ["LSOA 2021 Code", "Mid-2015: Population", "Mid-2016: Population",
                                   "Mid-2015: People per Sq Km", "Mid-2016: People per Sq Km"]).write.parquet(
        str(root / "pop.parquet"))
    for year in schemas.IMD_YEARS:
        spark.createDataFrame([(c, float(year)) for c in codes], ["LSOA code", "Education, Skills and Training Score"]
                              ).write.parquet(str(root / f"imd{year}.parquet"))
    spark.createDataFrame([(c, "x", 7) for c in codes[:4]], ["LSOA code", "AREA_NAME", "FLATS"]).write.parquet(
        str(root / "housing.parquet"))
    return root


def test_from_extracts_to_rosters(spark, region):
    at = lambda name: str(region / name)
    jobs.main(["lookup", "--files", at("oa.csv"), at("lad.csv"), at("ward.csv"), "--out", at("areas"), "--prefix", "E09"])
    assert spark.read.parquet(at("areas")).columns == schemas.AREA_LOOKUP.names
    jobs.main(["collect", "--events", at("raw"), "--lookup", at("areas"), "--out", at("events")])
    events = spark.read.parquet(at("events"))
    assert {r[0] for r in events.select("Crime type").distinct().collect()} == {"Burglary"}
    assert events.filter("`LSOA code` >= 'E06'").count() == 0
    jobs.main(["neighbors", "--centroids", at("pwc.csv"), "--out", at("edges")])
    jobs.main(["dataset", "--events", at("events"), "--out", at("data"), "--population", at("pop.parquet"),
               "--imd", at("imd2010.parquet"), at("imd2015.parquet"), at("imd2019.parquet"),
               "--housing", at("housing.parquet"), "--edges", at("edges"), "--classes", at("classes.csv")])
    table = spark.read.parquet(at("data/features.parquet"))
    assert table.filter("`LSOA code` = 'E01'").count() == 0
    assert table.agg({jobs.TARGET: "sum"}).first()[0] == events.filter("`LSOA code` != 'E01'").count()
    assert {r[0] for r in table.select("Education, Skills and Training Score").distinct().collect()} == {2015.0}
    last = table.filter("year = 2017").select("population").distinct().collect()
    assert [r[0] for r in last] == [102]
    x, y = spark.read.parquet(at("data/X_train.parquet")), spark.read.parquet(at("data/y_train.parquet"))
    test = spark.read.parquet(at("data/X_test.parquet"))
    assert x.count() == y.count() and x.count() + test.count() == table.count()
    assert jobs.TARGET not in x.columns and y.columns == ["LSOA code", "year", "month", jobs.TARGET]

    features = ["time_index_norm", f"{jobs.TARGET}_lag_1", "neighbor_burglary_avg"]
    fitted = m.train_forest(x.join(y, ["LSOA code", "year", "month"]), features, jobs.TARGET, numTrees=2, maxDepth=2)
    fitted.save(at("model"))
    jobs.main(["forecast", "--model", at("model"), "--features", at("data/X_test.parquet"), "--lookup", at("areas"),
               "--start", "2018-01", "--end", "2018-02", "--out", at("tree")])
    jobs.main(["train", "--features", at("data/features.parquet"), "--model", at("tuned"), "--report", at("report"),
               "--trials", "1", "--objectives", "poisson", "--columns", *features])
    parts = {r["part"] for r in spark.read.option("header", True).csv(at("report/metrics")).collect()}
    assert parts == {"train", "test"}
    jobs.main(["forecast", "--model", at("tuned"), "--features", at("data/X_test.parquet"), "--lookup", at("areas"),
               "--start", "2018-01", "--end", "2018-02", "--out", at("tree2")])
    jobs.main(["csv-rosters", "--predictions", at("tree2"), "--months", "2018-01", "2018-02", "--out", at("csv")])
    daily = spark.read.option("header", True).csv(at("csv/daily"))
    assert daily.count() > 0 and "officers_assigned" in daily.columns
    jobs.main(["rosters", "--predictions", at("nothing"), at("tree"), "--history", at("data/features.parquet"),
               "--months", "2018-01", "2018-02", "--out", at("full")])
    doc = json.loads(spark.read.text(at("full")).first()["value"])
    wards = doc["E09"]["wards"]
    areas = {k: v for w in wards.values() for k, v in w["lsoas"].items()}
    assert set(areas) == {r[0] for r in table.select("LSOA code").distinct().collect()}
    for entry in areas.values():
        assert set(entry["predictions"]) == {"2018-01", "2018-02"} == set(entry["officer_assignments"]["hourly"])
        assert sum(entry["historical"].values()) > 0
        assert all(len(v) == 24 for v in entry["officer_assignments"]["hourly"].values())


def test_bad_months_are_refused(region):
    with pytest.raises(SystemExit):
        jobs.main(["forecast", "--model", "m", "--features", "f", "--lookup", "l", "--start", "2018-02", "--end",
                   "2018-01", "--out", "o"])


@pytest.fixture(scope="module")
def sources(region):
    """The source files of the preparation jobs, in the layout in which they are published."""
    codes = [f"E{i:02d}" for i in range(8)]
    for year, positions in schemas.IMD_POSITIONS.items():
        width = max(positions) + 2
        names = {2010: {v: k for k, v in schemas.IMD_2010_HEADERS.items()},
                 2019: {v: k for k, v in schemas.IMD_2019_HEADERS.items()}}.get(year, {})
        head = [f"other {i}" for i in range(width)]
        for at, name in zip(positions, schemas.IMD_COLUMNS):
            head[at] = names.get(name, name)
        lines = [head]
        for i, c in enumerate(codes[:7]):  # the last area has no score
            row = ["x"] * width
            for k, at in enumerate(positions):
                row[at] = c if k == 0 else str(year + i + k / 10)
            lines.append(row)
        (region / f"ID {year}.csv").write_text("\n".join('"' + '","'.join(r) + '"' for r in lines))
    (region / "dwellings.csv").write_text("GEOGRAPHY,ECODE,AREA_NAME,BAND,FLATS,ALL\n" + "\n".join(
        f'{g},{c},Area,{b},{f},"1,0{i}0"' for i, c in enumerate([*codes, "Z99"])
        for g, b, f in (("LSOA", "All", "-" if i == 2 else i), ("LSOA", "A", 9), ("MSOA", "All", 9))))
    flats = ",".join(schemas.RESIDENTIAL_COLUMNS)
    (region / "cover.csv").write_text(f"LSOA11CD,LSOA11NM,{flats},Forest [311] (2018),Forest [311] (2012)\n" + "\n".join(
        f"{c},Area {c},{30 + i},{'' if i == 1 else 10},{45 - i},99" for i, c in enumerate([*codes, "Z99"])))
    return region


def test_preparation_jobs_feed_the_feature_table(spark, sources):
    at = lambda name: str(sources / name)
    jobs.main(["lookup", "--files", at("oa.csv"), at("lad.csv"), at("ward.csv"), "--out", at("all_areas")])
    jobs.main(["deprivation", "--files", *[at(f"ID {y}.csv") for y in schemas.IMD_POSITIONS], "--lookup", at("all_areas"),
               "--out", at("imd")])
    for year in schemas.IMD_POSITIONS:
        rows = {r["LSOA code"]: r for r in spark.read.parquet(at(f"imd/imd_{year}.parquet")).collect()}
        assert len(rows) == 8 and rows["E07"]["IMD Score"] is None
        assert list(rows["E03"].asDict()) == ["LSOA code", *schemas.IMD_COLUMNS[1:]]
        assert rows["E03"]["IMD Score"] == pytest.approx(year + 3.1) and rows["E03"]["Crime Score"] == pytest.approx(year + 3.6)
    jobs.main(["housing", "--dwellings", at("dwellings.csv"), "--lookup", at("all_areas"), "--out", at("homes")])
    homes = {r["LSOA code"]: r for r in spark.read.parquet(at("homes")).collect()}
    assert sorted(homes) == [f"E{i:02d}" for i in range(8)]
    assert homes["E02"]["FLATS"] == 0 and homes["E05"]["FLATS"] == 5 and homes["E05"]["ALL"] == 1050
    jobs.main(["residential", "--cover", at("cover.csv"), "--lookup", at("all_areas"), "--out", at("land")])
    assert spark.read.csv(at("land/percent"), header=True).count() == 9
    classes = {r.LSOA21CD: r for r in spark.read.csv(at("land/classification"), header=True).collect()}
    assert len(classes) == 8 and classes["E01"].is_residential_dominant == "false" and classes["E00"].is_residential_dominant == "false"
    assert classes["E04"].is_residential_dominant == "true" and float(classes["E04"].residential_advantage) == 3.0
    jobs.main(["collect", "--events", at("raw"), "--lookup", at("all_areas"), "--out", at("all_events")])
    jobs.main(["dataset", "--events", at("all_events"), "--imd", *[at(f"imd/imd_{y}.parquet") for y in schemas.IMD_POSITIONS],
               "--housing", at("homes"), "--classes", at("land/classification"), "--out", at("prepared")])
    table = spark.read.parquet(at("prepared/features.parquet"))
    assert {"IMD Score", "FLATS"} <= set(table.columns) or {"IMD_Score", "FLATS"} <= set(table.columns)
    assert {r[0] for r in table.select("LSOA code").distinct().collect()} <= {c for c, r in classes.items() if r.is_residential_dominant == "true"}


def test_point_tree_job(spark, sources):
    at = lambda name: str(sources / name)
    jobs.main(["points", "--events", at("all_events"), "--lookup", at("all_areas"), "--classes", at("land/classification"),
               "--out", at("points"), "--report", at("points_report")])
    found = {}
    for line in spark.read.text(at("points")).collect():
        for lad, l in json.loads(line.value).items():
            for w in l["wards"].values():
                found.update(w["lsoas"])
    events = spark.read.parquet(at("all_events")).toPandas()
    kept = events[events["LSOA code"].isin(["E03", "E04", "E05", "E06", "E07"])]
    assert set(found) == set(kept["LSOA code"])
    for code, entry in found.items():
        own = kept[kept["LSOA code"] == code]
        assert entry["total_burglary_count"] == len(own) == sum(map(len, entry["burglaries_by_month"].values()))
        assert entry["months_with_data"] == sorted(set(own["Month"]))
    report = spark.read.csv(at("points_report"), header=True, inferSchema=True).first()
    assert report.n_events == len(kept) and report.n_locations == len(found)
