"""Column expressions on the values the benchmark tables do not hold."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from haulage.functions import (
    as_date_text,
    concat_strict,
    falsy_to_null,
    has_scheme,
    join_text,
    json_field,
    json_text,
    last_segment,
    load_date_key,
    map_code,
    season_of,
    target_name,
)


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_join_text_skips_nulls_but_not_empty_text(spark):
    rows = [("A", "B"), ("A", None), (None, "B"), (None, None), ("", "D")]
    found = values(spark, "first string, last string", rows, join_text(", ", "first", "last"))
    assert found == ["A, B", "A", "B", "", ", D"]


def test_concat_strict_is_null_with_any_null(spark):
    rows = [("A", "B"), ("A", None), (None, "B")]
    column = concat_strict(F.col("a"), F.lit(" "), F.col("b"))
    assert values(spark, "a string, b string", rows, column) == ["A B", None, None]


def test_map_code_is_case_sensitive(spark):
    rows = [("M",), ("F",), ("m",), ("",), (None,)]
    column = map_code("g", {"M": "Male", "F": "Female"}, "Unknown")
    found = values(spark, "g string", rows, column)
    assert found == ["Male", "Female", "Unknown", "Unknown", "Unknown"]


def test_map_code_without_labels(spark):
    assert values(spark, "g string", [("M",)], map_code("g", {}, "Unknown")) == ["Unknown"]


@pytest.mark.parametrize(
    ("dtype", "rows", "expected"),
    [
        (T.StringType(), ["", "0", " ", None], [None, "0", " ", None]),
        (T.IntegerType(), [0, 1, -1, None], [None, 1, -1, None]),
        (T.DoubleType(), [0.0, -0.0, 0.5], [None, None, 0.5]),
        (T.BooleanType(), [True, False, None], [True, None, None]),
        (T.ArrayType(T.IntegerType()), [[], [0], None], [None, [0], None]),
        (T.BinaryType(), [bytearray(b""), bytearray(b"a")], [None, bytearray(b"a")]),
        (T.DateType(), [dt.date(1970, 1, 1), None], [dt.date(1970, 1, 1), None]),
    ],
)
def test_falsy_to_null_by_type(spark, dtype, rows, expected):
    schema = T.StructType([T.StructField("v", dtype)])
    assert values(spark, schema, [(r,) for r in rows], falsy_to_null("v", dtype)) == expected


@pytest.mark.parametrize(
    "text", ["null", "false", '""', "0", "-0", "0.0", "0.00", "-0.0", "0e3", "-0e1", "0E-7", "[]", "{}"]
)
def test_falsy_json_value(spark, text):
    variant = F.parse_json("v")
    assert values(spark, "v string", [(text,)], falsy_to_null(variant, T.VariantType())) == [None]


@pytest.mark.parametrize("text", ['"0"', '"false"', "true", "1", "0.1", '" "', "[0]", '{"a":null}', '"[]"'])
def test_truthy_json_value(spark, text):
    kept = falsy_to_null(F.parse_json("v"), T.VariantType())
    assert values(spark, "v string", [(text,)], F.to_json(kept)) == [text]


def test_falsy_of_absent_variant_is_null(spark):
    variant = falsy_to_null(F.parse_json("v"), T.VariantType())
    assert values(spark, "v string", [(None,)], variant) == [None]


def test_url_parts(spark):
    rows = [
        ("https://host/a/b.jpg",),
        ("https://host/a.jpg?x=1/2",),
        ("https://host/a/",),
        ("b.jpg",),
        ("",),
        (None,),
    ]
    segments = ["b.jpg", "2", "", "b.jpg", "", None]
    assert values(spark, "u string", rows, last_segment("u")) == segments
    assert values(spark, "u string", rows, target_name("u")) == ["b.jpg", "2", None, "b.jpg", None, None]


def test_has_scheme(spark):
    rows = [("https://h/a",), ("HTTP://h",), ("//h/a",), ("h/a",), ("1a://h",), ("",), (None,)]
    expected = [True, True, False, False, False, False, False]
    assert values(spark, "u string", rows, has_scheme("u")) == expected


def test_load_date_key_and_season(spark):
    rows = [(dt.date(2026, 3, 7),), (dt.date(2026, 1, 1),), (dt.date(2024, 3, 1),), (None,)]
    key = load_date_key("d")
    assert values(spark, "d date", rows, key) == ["20260306", "20251231", "20240229", None]
    assert values(spark, "d date", rows, season_of(key)) == ["2026", "2025", "2024", None]


@pytest.mark.parametrize("run_date", ["2026-03-07", dt.date(2026, 3, 7), dt.datetime(2026, 3, 7, 9)])
def test_run_date_forms(run_date):
    assert as_date_text(run_date) == "2026-03-07"


def test_run_date_is_checked():
    with pytest.raises(ValueError):
        as_date_text("07/03/2026")


def test_json_text_keeps_nulls_and_non_ascii(spark):
    rows = [("Pérez", None)]
    column = json_text(F.struct("name", "team"))
    assert values(spark, "name string, team string", rows, column) == ['{"name":"Pérez","team":null}']


def test_json_field(spark):
    rows = [('{"a":{"b":1}}',), ('{"a":null}',), ("not json",), (None,)]
    assert values(spark, "v string", rows, json_field("v", "$.a.b")) == ["1", None, None, None]
