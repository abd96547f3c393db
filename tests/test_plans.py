from __future__ import annotations

import copy
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from haulage.operators import CheckFailed
from haulage.plans import launches, parquet_copy, races, staging
from haulage.session import scratch_dir
from haulage.sinks import create_namespace, drop_table_load_date, replace_table
from haulage.sources.files import STANDARD
from haulage.sources import query_catalog, read_catalog_table, read_csv, read_json_documents


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text if isinstance(text, str) else json.dumps(text, ensure_ascii=False, indent=2))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- race documents ---

RESULT = {
    "driver": {"driverId": "d1", "name": "Sergio", "surname": "Pérez"},
    "team": {"teamId": "t1", "teamName": "Team"},
    "position": 1,
    "grid": "2",
    "points": 25,
    "time": "1:31:44",
    "fastLap": "1:34.0",
    "retired": None,
}


def race(*results, **changes):
    document = {
        "season": 2026,
        "races": {
            "raceId": "r1",
            "raceName": "Gran Premio de España",
            "round": 3,
            "date": "2026-03-06",
            "circuit": {"circuitId": "c1", "circuitName": "Circuit"},
            "results": [copy.deepcopy(r) for r in results],
        },
    }
    document["races"].update(changes)
    return document


def without(document, *path):
    document = copy.deepcopy(document)
    inner = document
    for key in path[:-1]:
        inner = inner[key]
    del inner[path[-1]]
    return document


def record(**changes):
    """The record of ``RESULT`` in ``race``, written out by hand, with changes."""
    return {
        "race_id": "r1",
        "race_name": "Gran Premio de España",
        "race_season": 2026,
        "race_round": 3,
        "race_date": "2026-03-06",
        "circuit_id": "c1",
        "circuit_name": "Circuit",
        "driver_id": "d1",
        "driver_name": "Sergio Pérez",
        "team_id": "t1",
        "team_name": "Team",
        "position": 1,
        "grid_position": "2",
        "points": 25,
        "time": "1:31:44",
        "fastest_lap_time": "1:34.0",
        "retired": None,
    } | changes


def stored(path, load_date):
    """The records of one load date as parsed JSON."""
    found = []
    folder = f"{path}/load_date={load_date}"
    for name in os.listdir(folder):
        if name.startswith("part-"):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                found += [json.loads(line) for line in f]
    return found


def by_text(records):
    return sorted(json.dumps(r, ensure_ascii=False) for r in records)


def test_race_records_are_as_written_out(spark, tmp_path):
    documents = [
        race(RESULT, {**RESULT, "position": "NC", "time": None, "points": 0.5, "retired": "DNF"}),
        race(
            {**RESULT, "fastLap": "", "retired": False},
            {**RESULT, "fastLap": 0, "retired": []},
            {k: v for k, v in RESULT.items() if k not in ("fastLap", "retired")},
            {**RESULT, "retired": True, "extra": {"ignored": 1}},
            raceId=77,
            raceName=None,
        ),
        race(raceId="no results"),
    ]
    for i, document in enumerate(documents):
        put(tmp_path / "in", f"{i}.json", document)
    output = scratch_dir(spark, "races")
    for _ in range(2):
        done = races.run(spark, str(tmp_path / "in"), output, "2026-03-07")
        assert done.rows == 6
    second = {"race_id": 77, "race_name": None}
    expected = [
        record(),
        record(position="NC", time=None, points=0.5, retired="DNF"),
        record(**second, fastest_lap_time=None),
        record(**second, fastest_lap_time=None),
        record(**second, fastest_lap_time=None),
        record(**second, retired=True),
    ]
    assert by_text(stored(output, "20260306")) == by_text(expected)
    typed = races.read_results(spark, output)
    assert typed.columns == [*races.RECORD.fieldNames(), "load_date"]
    first = typed.filter("race_id = 'r1' AND position = '1'").first()
    assert (first.driver_name, first.points, first.race_round) == ("Sergio Pérez", 25.0, 3)
    assert {r.load_date for r in typed.collect()} == {"20260306"}


@pytest.mark.parametrize(
    ("path", "named"),
    [
        (("season",), "season"),
        (("races", "raceId"), "races.raceId"),
        (("races", "circuit"), "races.circuit.circuitId, races.circuit.circuitName"),
        (("races", "results"), "races.results"),
        (("races", "results", 0, "time"), "time"),
        (("races", "results", 0, "driver", "surname"), "driver.surname"),
        (("races", "results", 0, "team"), "team.teamId, team.teamName"),
    ],
)
def test_missing_race_key_fails_and_keeps_old_records(spark, tmp_path, path, named):
    output = scratch_dir(spark, "races")
    put(tmp_path / "good", "a.json", race(RESULT))
    races.run(spark, str(tmp_path / "good"), output, "2026-03-07")
    put(tmp_path / "bad", "a.json", without(race(RESULT), *path))
    with pytest.raises(Exception, match=f"missing required keys: {named}"):
        races.run(spark, str(tmp_path / "bad"), output, "2026-03-07")
    assert len(stored(output, "20260306")) == 1


def test_null_name_part_fails(spark, tmp_path):
    bad = {**RESULT, "driver": {"driverId": "d", "name": "A", "surname": None}}
    put(tmp_path, "a.json", race(bad))
    documents = read_json_documents(spark, str(tmp_path), races.DOCUMENT)
    with pytest.raises(Exception, match="driver.surname"):
        races.flatten(documents).collect()
    with pytest.raises(Exception, match="driver.surname"):
        races.flatten(documents).select("time").filter("time IS NOT NULL").collect()


def test_missing_key_in_a_document_without_results_fails(spark, tmp_path):
    put(tmp_path, "a.json", without(race(), "races", "raceId"))
    documents = read_json_documents(spark, str(tmp_path), races.DOCUMENT)
    with pytest.raises(Exception, match="races.raceId"):
        races.flatten(documents).count()


def test_malformed_race_document_fails(spark, tmp_path):
    put(tmp_path, "a.json", '{"season": 2026, "races": {')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        races.run(spark, str(tmp_path), scratch_dir(spark, "races"), "2026-03-07")


def test_no_documents_is_an_error(spark, tmp_path):
    os.makedirs(tmp_path / "empty")
    with pytest.raises(CheckFailed, match="no rows"):
        races.run(spark, str(tmp_path / "empty"), scratch_dir(spark, "races"), "2026-03-07")


def test_empty_rerun_leaves_no_stale_records(spark, tmp_path):
    output = scratch_dir(spark, "races")
    put(tmp_path, "a.json", race(RESULT))
    races.run(spark, str(tmp_path), output, "2026-03-07")
    races.run(spark, str(tmp_path), output, "2026-03-08")
    put(tmp_path, "a.json", race())
    races.run(spark, str(tmp_path), output, "2026-03-08")
    assert [r.load_date for r in races.read_results(spark, output).collect()] == ["20260306"]


def test_every_accepted_record_can_be_read_back(spark, tmp_path):
    output = scratch_dir(spark, "races")
    put(tmp_path, "a.json", {**race({**RESULT, "points": "25"}, round="24"), "season": "2026"})
    put(tmp_path, "b.json", race({**RESULT, "points": "none"}, round=1.5))
    put(tmp_path, "c.json", race({**RESULT, "points": None}, round="7.0"))
    races.run(spark, str(tmp_path), output, "2026-03-07")
    found = races.read_results(spark, output).select("race_season", "race_round", "points")
    assert rows(found) == sorted([(2026, 24, 25.0), (2026, None, None), (2026, 7, None)], key=repr)


def test_flatten_needs_no_shuffle(spark, tmp_path):
    put(tmp_path, "a.json", race(RESULT))
    documents = read_json_documents(spark, str(tmp_path), races.DOCUMENT)
    assert "Exchange" not in plan(races.flatten(documents))


def test_load_date_is_the_day_before():
    assert races.load_date_of("2026-01-01") == "20251231"


# --- launch documents ---


def images(*urls):
    return {"results": [{"image": url, "name": "launch"} for url in urls]}


def test_image_manifest(spark, tmp_path):
    put(tmp_path / "in", "1.json", images("https://a/x.jpg", "https://b/y.png", None, "c/x.jpg"))
    put(tmp_path / "in", "2.json", images("https://c/x.jpg", "https://d/dir/", "https://e/z?q=1", 5, ""))
    output = scratch_dir(spark, "manifest")
    for _ in range(2):
        done = launches.run(spark, str(tmp_path / "in"), output)
        assert (done.files, done.valid_urls, done.invalid_urls) == (3, 4, 5)
    manifest = spark.read.parquet(f"{output}/manifest").select("name", "url")
    assert rows(manifest) == [
        ("x.jpg", "https://c/x.jpg"),
        ("y.png", "https://b/y.png"),
        ("z?q=1", "https://e/z?q=1"),
    ]
    invalid = spark.read.parquet(f"{output}/listing").filter("NOT valid").select("url")
    assert rows(invalid) == sorted([(None,), ("c/x.jpg",), ("https://d/dir/",), ("5",), ("",)], key=repr)


def test_later_launch_wins_in_one_document(spark, tmp_path):
    put(tmp_path, "1.json", images("https://a/x.jpg", "https://b/x.jpg", "x.jpg"))
    documents = read_json_documents(spark, str(tmp_path), launches.DOCUMENT)
    listing = launches.list_images(documents, F.lit("only"))
    assert rows(launches.manifest(listing)) == [("x.jpg", "https://b/x.jpg")]
    assert rows(launches.file_count(listing)) == [(1,)]


@pytest.mark.parametrize(
    "document", [{}, {"results": None}, {"results": [{"name": "x"}]}, {"results": [None]}]
)
def test_launch_without_image_key_fails(spark, tmp_path, document):
    put(tmp_path, "1.json", document)
    documents = read_json_documents(spark, str(tmp_path), launches.DOCUMENT)
    with pytest.raises(Exception, match="missing required keys"):
        launches.list_images(documents, F.lit("only")).collect()
    with pytest.raises(Exception, match="missing required keys"):
        launches.manifest(launches.list_images(documents, F.lit("only"))).collect()


def test_failed_rerun_keeps_listing_and_manifest(spark, tmp_path):
    output = scratch_dir(spark, "manifest")
    put(tmp_path, "1.json", images("https://a/x.jpg", "x.jpg"))
    launches.run(spark, str(tmp_path), output)
    put(tmp_path, "2.json", {"results": [{"name": "no image"}]})
    with pytest.raises(Exception, match="missing required keys"):
        launches.run(spark, str(tmp_path), output)
    assert spark.read.parquet(f"{output}/listing").count() == 2
    assert rows(spark.read.parquet(f"{output}/manifest")) == [("x.jpg", "https://a/x.jpg")]


def test_later_line_wins_in_json_lines(spark, tmp_path):
    lines = [json.dumps(images(f"https://host{i}/x.jpg")) for i in range(2000)]
    put(tmp_path, "a.json", "\n".join(lines))
    output = scratch_dir(spark, "manifest")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")  # several blocks of one file
    try:
        launches.run(spark, str(tmp_path), output, multi_line=False)
    finally:
        spark.conf.set(key, before)
    assert rows(spark.read.parquet(f"{output}/manifest")) == [("x.jpg", "https://host1999/x.jpg")]


# --- CSV to Parquet ---

SALES = (
    "date,product,quantity,unit_price\n"
    "2031-05-04,Lantern,6,12.25\n"
    "2031-05-09,Rope,,3.5\n"
)


def test_parquet_copy(spark, tmp_path):
    put(tmp_path, "sales.csv", SALES)
    output = scratch_dir(spark, "parquet")
    for _ in range(2):
        copied = parquet_copy.run(spark, str(tmp_path / "sales.csv"), output)
    assert [t for _, t in copied.dtypes] == ["date", "string", "int", "double"]
    assert rows(copied.select("product", "quantity")) == [("Lantern", 6), ("Rope", None)]


def test_failed_parquet_copy_keeps_the_old_table(spark, tmp_path):
    output = scratch_dir(spark, "parquet")
    put(tmp_path, "sales.csv", SALES)
    schema = "date date, product string, quantity int, unit_price double"
    parquet_copy.run(spark, str(tmp_path / "sales.csv"), output, schema)
    put(tmp_path, "sales.csv", SALES + "2031-05-10,Rope,many,3.5\n")
    with pytest.raises(Exception):
        parquet_copy.run(spark, str(tmp_path / "sales.csv"), output, schema)
    assert spark.read.parquet(output).count() == 2


def test_standard_csv_keeps_line_breaks_and_quotes(spark, tmp_path):
    put(tmp_path, "a.csv", 'k,v\n1,"two\nlines"\n2,"say ""hi"", x"\n')
    copied = parquet_copy.run(
        spark, str(tmp_path / "a.csv"), scratch_dir(spark, "parquet"), dialect=STANDARD
    )
    assert rows(copied) == [(1, "two\nlines"), (2, 'say "hi", x')]


def test_reordered_header_fails_a_copy(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "a,b\n1,2\n")
    put(tmp_path / "in", "2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        parquet_copy.run(spark, str(tmp_path / "in"), scratch_dir(spark, "parquet"))


def test_parquet_copy_with_schema_reads_once(spark, tmp_path):
    put(tmp_path, "sales.csv", SALES)
    schema = "date date, product string, quantity long, unit_price decimal(9,2)"
    copied = parquet_copy.run(
        spark, str(tmp_path / "sales.csv"), scratch_dir(spark, "parquet"), schema
    )
    assert copied.schema.simpleString() == (
        "struct<date:date,product:string,quantity:bigint,unit_price:decimal(9,2)>"
    )


# --- catalog tables ---


@pytest.fixture
def namespace(spark):
    name = f"ns_{uuid.uuid4().hex}"
    create_namespace(spark, name, scratch_dir(spark, name))
    yield name
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def test_create_namespace_twice(spark, namespace):
    create_namespace(spark, namespace)
    assert spark.catalog.databaseExists(namespace)


def test_stage_csv_folder(spark, tmp_path, namespace):
    put(tmp_path, "1.csv", "k,name\n1,a\n")
    table = f"{namespace}.circuits"
    staging.run(spark, str(tmp_path), table)
    put(tmp_path, "2.csv", "k,name\n2,b\n")
    for _ in range(2):
        assert rows(staging.run(spark, str(tmp_path), table)) == [(1, "a"), (2, "b")]
    found = query_catalog(spark, f"SELECT name FROM {table} WHERE k = :k", k=2)
    assert rows(found) == [("b",)]
    properties = dict(r[:2] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect())
    assert properties["write.format.default"] == "parquet"


@pytest.mark.parametrize(("keep", "folders"), [(False, 1), (True, 3)])
def test_staging_leaves_as_many_versions_as_asked(spark, tmp_path, keep, folders):
    name, location = f"ns_{uuid.uuid4().hex}", scratch_dir(spark, "staging")
    put(tmp_path, "1.csv", "k,name\n1,a\n")
    for _ in range(3):
        staging.run(
            spark, str(tmp_path), f"{name}.t", namespace_location=location, keep_previous_files=keep
        )
    assert len(os.listdir(location.removeprefix("file:"))) == folders
    assert spark.table(f"{name}.t").count() == 1
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def test_a_folder_of_someone_else_is_not_dropped(spark, tmp_path, namespace):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    spark.catalog.createTable(f"{namespace}.t", path=str(tmp_path / "own"), source="parquet")
    replace_table(spark.range(4), f"{namespace}.t", drop_previous_files=True)
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


def test_replace_changes_schema_and_rows(spark, namespace):
    table = f"{namespace}.t"
    replace_table(spark.range(3), table)
    replace_table(spark.range(2).withColumn("v", F.lit("x")), table)
    assert rows(read_catalog_table(spark, table)) == [(0, "x"), (1, "x")]


def test_failed_replace_keeps_the_old_table(spark, namespace):
    table = f"{namespace}.t"
    replace_table(spark.range(3), table)
    broken = spark.range(9).select(
        F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id")
    )
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, table)
    assert read_catalog_table(spark, table).count() == 3


def test_a_table_can_be_replaced_from_itself(spark, namespace):
    table = f"{namespace}.t"
    replace_table(spark.range(5), table)
    replace_table(read_catalog_table(spark, table).filter("id > 2"), table)
    assert rows(read_catalog_table(spark, table)) == [(3,), (4,)]


@pytest.mark.parametrize("made_by", ["partitioned", "orc", "managed"])
def test_tables_made_otherwise_can_be_replaced(spark, namespace, made_by):
    table = f"{namespace}.t"
    df = spark.range(4).withColumn("day", F.lit("a"))
    writer = df.write.format("orc" if made_by == "orc" else "parquet")
    if made_by == "partitioned":
        writer = writer.partitionBy("day")
    writer.saveAsTable(table)
    for rows_now in (3, 2):
        replace_table(spark.range(rows_now).withColumn("day", F.lit("b")), table)
        assert rows(read_catalog_table(spark, table)) == [(i, "b") for i in range(rows_now)]


def test_previous_files_can_be_dropped(spark, namespace):
    table = f"{namespace}.t"
    replace_table(spark.range(5), table)
    before = read_catalog_table(spark, table).inputFiles()
    replace_table(spark.range(6), table, drop_previous_files=True)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in before)
    assert read_catalog_table(spark, table).count() == 6


@pytest.mark.parametrize("made_by", ["replace_table", "saveAsTable"])
def test_files_of_a_managed_table_do_not_outlive_it(spark, namespace, made_by):
    table = f"{namespace}.gone"
    replace = replace_table if made_by == "replace_table" else (lambda df, name: df.write.saveAsTable(name))
    replace(spark.range(5), table)
    files = list(read_catalog_table(spark, table).inputFiles())
    for v in ("a", "b"):  # other columns, then the same ones
        replace_table(spark.range(6).withColumn("v", F.lit(v)), table, drop_previous_files=True)
        files += read_catalog_table(spark, table).inputFiles()
    assert read_catalog_table(spark, table).count() == 6
    spark.sql(f"DROP TABLE {table}")
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_drop_load_date_of_table(spark, namespace):
    table = f"{namespace}.dated"
    df = spark.createDataFrame([(1, "20260101"), (2, "20260102")], "k int, load_date string")
    df.write.partitionBy("load_date").saveAsTable(table)
    for _ in range(2):
        drop_table_load_date(spark, table, "20260101")
        assert rows(read_catalog_table(spark, table)) == [(2, "20260102")]


def test_declared_csv_schema_is_kept(spark, tmp_path):
    put(tmp_path, "a.csv", "k\n01\n")
    assert rows(read_csv(spark, str(tmp_path), schema="k string")) == [("01",)]
