"""Files that can be split, unlike headers, bad rows apart, types by one read, file sizes."""

from __future__ import annotations

import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from haulage import registry
from haulage.operators import CheckFailed, verify
from haulage.operators.checks import observed_metrics
from haulage.plans import launches, parquet_copy, staging
from haulage.session import scratch_dir, session_setting
from haulage.sinks import bad_rows, compressed, good_rows, replace_load_dates, write_apart, write_csv
from haulage.sources import (
    LOSSLESS,
    landed_by_date,
    landed_files,
    read_csv,
    read_csv_by_name,
    read_csv_inferred,
    read_csv_tolerant,
    read_json_tolerant,
    read_load_dates,
)
from haulage.sources import inferred


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


# --- lossless CSV ---


def test_one_lossless_file_is_read_by_several_tasks(spark):
    path = scratch_dir(spark, "csv")
    text = F.concat(F.lit('line "one",\r\nline two\\n \\N;'), F.col("id").cast("string"), F.lit("\n"))
    df = spark.range(5000).select("id", text.alias("v"), F.lit(" \r").alias("w")).coalesce(1)
    written = write_csv(df, path, LOSSLESS, checksum=True)
    with session_setting(spark, "spark.sql.files.maxPartitionBytes", "32k"), session_setting(spark, "spark.sql.files.openCostInBytes", "1k"):
        back = read_csv(spark, path, df.schema, dialect=LOSSLESS)
        assert back.rdd.getNumPartitions() >= 4
        assert rows(back) == rows(df)
        verify(written, read_csv(spark, path, dialect=LOSSLESS), "csv")
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


awkward = st.one_of(st.none(), st.text('ab\\nrsN\n\r\t",; \x00é ', max_size=12))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(awkward, min_size=1, max_size=30))
def test_every_text_comes_back(spark, texts):
    path = scratch_dir(spark, "csv")
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string").coalesce(1)
    write_csv(df, path, LOSSLESS)
    assert rows(read_csv(spark, path, df.schema, dialect=LOSSLESS)) == rows(df)


# --- unlike headers ---


def test_files_are_matched_by_column_name(spark, tmp_path):
    put(tmp_path, "1.csv", "a,b\n1,x\n2,y\n")
    put(tmp_path, "2.csv", "b,a\nz,3\n")
    put(tmp_path, "3.csv", "a,c\n4,new\n")
    put(tmp_path, "4.csv", "")
    put(tmp_path, "5.csv", "b,a\n")
    put(tmp_path, "_hidden.csv", "q\n1\n")
    found = read_csv_by_name(spark, str(tmp_path))
    assert found.columns == ["a", "b", "c"] and {t for _, t in found.dtypes} == {"string"}
    assert rows(found.select("a", "b", "c")) == [("1", "x", None), ("2", "y", None), ("3", "z", None), ("4", None, "new")]
    typed = read_csv_by_name(spark, str(tmp_path), "b string, a int, d date")
    assert typed.dtypes == [("b", "string"), ("a", "int"), ("d", "date"), ("c", "string")]
    assert read_csv_by_name(spark, str(tmp_path), "a int", extra_columns=False).columns == ["a"]
    put(tmp_path, "6.csv", "a,b\nnumber,x\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_csv_by_name(spark, str(tmp_path), "a int, b string").collect()


def test_no_file_and_too_many_headers(spark, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError):
        read_csv_by_name(spark, str(tmp_path))
    for i in range(4):
        put(tmp_path, f"{i}.csv", f"a{i}\n1\n")
    monkeypatch.setattr("haulage.sources.files.MAX_HEADERS", 3)
    with pytest.raises(ValueError, match="4 unlike headers"):
        read_csv_by_name(spark, str(tmp_path))


def test_staging_by_name(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "k,day\n1,2026-03-07\n")
    put(tmp_path / "in", "2.csv", "day,k,note\n2026-03-08,2,x\n")
    namespace = f"by_name_{os.getpid()}"
    table = staging.run(spark, str(tmp_path / "in"), f"{namespace}.t", properties=None, namespace_location=str(tmp_path / "ns"), by_name=True)
    assert [t for _, t in table.dtypes] == ["int", "date", "string"]
    assert [(r.k, r.note) for r in table.orderBy("k").collect()] == [(1, None), (2, "x")]
    spark.sql(f"DROP TABLE {namespace}.t")


# --- bad rows apart ---

TYPES = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def test_good_and_bad_rows_land_apart(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "k,v\n1,a\nx,b\n3,c,d\n4\n5,\n6,e\n")
    path = scratch_dir(spark, "apart")
    counts = write_apart(read_csv_tolerant(spark, str(tmp_path / "in"), TYPES), path, required=["v"], max_bad_share=0.9)
    assert (counts.good, counts.bad) == (2, 4)
    assert rows(good_rows(spark, path, TYPES)) == [(1, "a"), (6, "e")]
    bad = bad_rows(spark, path, TYPES).collect()
    assert sorted((r._reason, r._bad_row) for r in bad if r._bad_row) == [("malformed", "3,c,d"), ("malformed", "4"), ("malformed", "x,b")]
    assert [(r._reason, r.k) for r in bad if not r._bad_row] == [("missing v", 5)]
    assert all(r._file.endswith("1.csv") for r in bad)


def test_too_many_bad_rows_change_nothing(spark, tmp_path):
    path = scratch_dir(spark, "apart")
    put(tmp_path / "a", "1.csv", "k,v\n1,a\n")
    write_apart(read_csv_tolerant(spark, str(tmp_path / "a"), TYPES), path)
    put(tmp_path / "b", "1.csv", "k,v\n1,a\nx,b\n")
    with pytest.raises(CheckFailed, match="1 of 2 rows are bad"):
        write_apart(read_csv_tolerant(spark, str(tmp_path / "b"), TYPES), path, max_bad_share=0.4)
    assert rows(good_rows(spark, path, TYPES)) == [(1, "a")]
    assert [r._bad_row for r in spark.read.parquet(f"{path}-rejected").collect()] == ["x,b"]


def test_no_rows_and_no_bad_rows(spark, tmp_path):
    put(tmp_path, "1.csv", "k,v\n")
    path = scratch_dir(spark, "apart")
    counts = write_apart(read_csv_tolerant(spark, str(tmp_path), TYPES), path, max_bad_share=0)
    assert (counts.good, counts.bad) == (0, 0)
    assert good_rows(spark, path, TYPES).count() == bad_rows(spark, path, TYPES).count() == 0


def test_wrong_header_still_fails(spark, tmp_path):
    put(tmp_path, "1.csv", "v,k\na,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv_tolerant(spark, str(tmp_path), TYPES).collect()
    with pytest.raises(ValueError, match="_bad_row"):
        read_csv_tolerant(spark, str(tmp_path), "k int, _bad_row string")


def test_bad_json_lines(spark, tmp_path):
    put(tmp_path, "1.json", '{"k": 1, "v": "a"}\n{"k": "x"\n{"k": {"deep": 1}, "v": "b"}\n')
    path = scratch_dir(spark, "apart")
    counts = write_apart(read_json_tolerant(spark, str(tmp_path), TYPES), path, max_bad_share=1)
    assert (counts.good, counts.bad) == (1, 2)


def test_bad_rows_of_the_lossless_dialect(spark, tmp_path):
    put(tmp_path, "1.csv", "k,v\n1,two\\nlines\nx,two\\nlines\n")
    got = read_csv_tolerant(spark, str(tmp_path), TYPES, LOSSLESS).collect()
    assert [(r.k, r.v) for r in got if r._bad_row is None] == [(1, "two\nlines")]
    assert [r._bad_row for r in got if r._bad_row] == ["x,two\\nlines"]


def test_tolerant_conversion(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "k,v\n1,a\nx,b\n")
    copy, counts = parquet_copy.run_tolerant(spark, str(tmp_path / "in"), str(tmp_path / "out"), TYPES, max_bad_share=0.5)
    assert rows(copy) == [(1, "a")] and (counts.good, counts.bad) == (1, 1)


# --- types by one read ---

INFERRED = {
    "int": ["1", "-2", None],
    "bigint": ["1", "3000000000"],
    "decimal(20,0)": ["12345678901234567890", "1"],
    "double": ["1", "2.5", "1e3", "NaN"],
    "date": ["2026-03-07", None],
    "timestamp": ["2026-03-07", "2026-03-07 01:02:03"],
    "boolean": ["true", "FALSE"],
    "string": ["1", "2026-03-07"],
}


def test_types_are_those_that_spark_infers(spark):
    columns = {kind: values + [None] * (4 - len(values)) for kind, values in INFERRED.items()}
    columns |= {"empty": [None] * 4, "mixed": ["true", "1", "x", None], "plus": ["+1", "01", "7", "8"]}
    data = list(zip(*columns.values(), strict=True))
    df = spark.createDataFrame(data, T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))]))
    path = scratch_dir(spark, "csv")
    write_csv(df.coalesce(1), path)
    twice, once = read_csv(spark, path, infer=True), read_csv_inferred(spark, path)
    assert once.dtypes == twice.dtypes
    assert repr(rows(once)) == repr(rows(twice))
    assert [t for _, t in once.dtypes][: len(INFERRED)] == list(INFERRED)


def test_inference_scans_the_csv_once(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "k,v\n1,2.5\n")
    found = read_csv_inferred(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "1.csv").unlink()  # the typed table reads the staged texts
    assert rows(found) == [(1, 2.5)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "Scan csv" not in plan


def test_inference_of_no_rows(spark, tmp_path):
    put(tmp_path, "1.csv", "k,v\n")
    assert read_csv_inferred(spark, str(tmp_path)).dtypes == [("k", "string"), ("v", "string")]


ODD_TEXTS = [
    None, "", " ", "0", "-0", "+7", " 12 ", "2147483648", "9223372036854775807", "9223372036854775808", "0" * 30 + "5",
    "9" * 38, "9" * 39, "7\n", "7\r\n", "7\x85", "\t7", "1.", ".5", ".", "-", "+", "1e5", "1E-400", "1e", "1f", "1D", "0x1p3",
    "0X1.8P-2", "0x1", "nan", "NaN", "+nan", "Infinity", "-INF", "inf", "infinit", "1_0", "1,5", "٣", "1 2", "\x001.5\x1f",
    "2026", "2026-3", "2026-03-07", " 2026-03-07 ", "2026-02-30", "0000-01-01", "9999-12-31", "2026-03-07T", "2026-03-07 25:00",
    "2026-03-07T01:02:03.000004", "12345-01-01", "true", " FALSE ", "t", "N", "O", "MAIL",
]


def test_flags_are_those_of_all_casts(spark):
    text = F.trim("t")
    whole = text.rlike(r"^[+-]?\d{1,38}$")
    fits = {
        "int": whole & text.try_cast("int").isNotNull(),
        "bigint": whole & text.try_cast("bigint").isNotNull(),
        "decimal": whole,
        "double": text.try_cast("double").isNotNull(),
        "date": text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(),
        "timestamp": text.rlike(r"^\d{4}-\d{1,2}") & text.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(text).isin("true", "false"),
    }
    expected = F.concat_ws(",", *[F.when(F.col("t").isNull() | fits[k], k) for k in inferred.KINDS])
    flags = inferred.fitting(F.col("t"))
    found = F.concat_ws(",", *[F.when(flags.bitwiseAND(F.lit(1 << i)) > 0, k) for i, k in enumerate(inferred.KINDS)])
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string").select("t", expected.alias("e"), found.alias("f"))
    assert [r for r in df.collect() if r.e != r.f] == []


def test_texts_that_are_no_numbers_are_not_cast(spark):
    # each failed cast to double costs an exception
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS if t is not None], "t string")
    tried, number = F.col("t").rlike(inferred._NUMBER), F.col("t").try_cast("double").isNotNull()
    assert df.filter(number & ~tried).count() == 0
    wasted = {r.t for r in df.filter(tried & ~number).collect()}
    assert not wasted & {"", "2026-03-07", "2026-03-07T01:02:03.000004", "N", "O", "MAIL", "true", "t", "1 2"}


def test_the_staging_pass_is_compiled(spark, monkeypatch):
    limits = []

    def watched(df, *args):
        limits.append(int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")))
        return observed_metrics(df, *args)

    monkeypatch.setattr(inferred, "observed_metrics", watched)
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    inferred.stage_inferred(spark.createDataFrame([tuple("1" * 12)], [f"c{i}" for i in range(12)]))
    assert limits == [8000]  # beyond it the JVM interprets a method
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


# --- landed files ---


def test_landed_files_by_date(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).withColumn("load_date", F.when(F.col("id") < 90, "20260306").otherwise("20260307"))
    replace_load_dates(df.repartition(3, "id"), path)
    listed = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                listed.setdefault(folder.rpartition("=")[2], []).append(os.path.getsize(os.path.join(folder, name)))
    found = {r.load_date: (r.files, r.bytes, r.smallest) for r in landed_by_date(spark, path).collect()}
    assert found == {date: (len(sizes), sum(sizes), min(sizes)) for date, sizes in listed.items()}
    files = landed_files(spark, path)
    assert files.count() == sum(map(len, listed.values()))
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


# --- manifest over runs ---


def test_manifest_keeps_the_files_of_earlier_runs(spark, tmp_path):
    output = scratch_dir(spark, "manifest")
    line = '{"results": [%s]}'
    image = lambda *urls: line % ", ".join(f'{{"image": "{u}"}}' for u in urls)
    put(tmp_path / "1", "a.json", image("http://a/x.jpg", "http://a/y.jpg"))
    put(tmp_path / "2", "a.json", image("http://b/y.jpg", "http://b/z.jpg"))
    first = launches.run(spark, str(tmp_path / "1"), output)
    second = launches.run(spark, str(tmp_path / "2"), output)
    assert (first.files, first.new_files, second.files, second.new_files) == (2, 2, 3, 1)
    wanted = [("x.jpg", "http://a/x.jpg"), ("y.jpg", "http://b/y.jpg"), ("z.jpg", "http://b/z.jpg")]
    assert rows(spark.read.parquet(f"{output}/manifest").select("name", "url")) == wanted
    alone = launches.run(spark, str(tmp_path / "1"), output, keep_earlier=False)
    assert alone.files == 2


# --- compressed load dates ---


def test_compressed_load_dates(spark, monkeypatch):
    path = scratch_dir(spark, "dated")
    df = spark.range(0, 1000, 1, 2).withColumn("load_date", F.lit("20260306"))
    options = compressed("gzip", 200)
    monkeypatch.setitem(replace_load_dates.__globals__, "compressed", lambda codec: options if codec else {})
    for _ in range(2):
        assert replace_load_dates(df, path, dates=["20260306"], compression="gzip").rows == 1000
    found = read_load_dates(spark, path, T.StructType.fromDDL("id long"))
    assert rows(found) == sorted(((i, "20260306") for i in range(1000)), key=repr)
    files = found.inputFiles()
    assert len(files) == 6 and all(f.endswith(".json.gz") for f in files)  # 500 records a task, 200 a file


def test_race_results_are_written_compressed(spark, tmp_path):
    spark.sql(
        "SELECT id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice,"
        " TIMESTAMP_NTZ '1996-01-02 00:00:00' AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(300)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    found = registry.race_results_by_date(spark, str(tmp_path))
    sizes = [os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in found.inputFiles()]
    assert found.count() == 2 * 4 * 300
    assert sum(sizes) < 50 * found.count()  # 350 bytes a record as plain text
