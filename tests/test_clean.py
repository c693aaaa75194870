import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from starloom.functions.clean import (
    boolean_value,
    bytes_to_text,
    complex_to_json,
    epoch_ms_to_timestamp,
    is_boolean_name,
    is_time_name,
    json_to_variant,
    normalize_booleans,
    normalize_timestamps,
    sanitize,
    to_bool,
)


def values(df):
    return [row[0] for row in df.collect()]


@pytest.mark.parametrize(
    "dtype, given, expected",
    [
        ("binary", [b"\x00", b"\x01", b"\x01\x00", b"", None], [False, True, True, False, None]),
        ("int", [0, 1, -3, None], [False, True, True, None]),
        ("string", ["", "0", "no", "b'\\x00'", "b'\\x01'", 'b"\\x00"', None], [False, True, True, False, True, False, None]),
        ("boolean", [True, False, None], [True, False, None]),
    ],
)
def test_to_bool(spark, dtype, given, expected):
    df = spark.createDataFrame([(v,) for v in given], f"v {dtype}").coalesce(1)
    assert values(df.select(to_bool(F.col("v"), df.schema["v"].dataType))) == expected


@pytest.mark.parametrize(
    "raw",
    [
        b"",
        "grüß 中".encode(),
        b"\xff",
        b"a\xfe'b",
        b'a\xfe"b',
        b"a\xfe'\"b",
        b"\\\xfe\n\r\t\x00\x7f~ ",
        bytes(range(256)),
        b"x" * 5000 + b"\xc3",
    ],
)
def test_bytes_to_text_is_python_text(spark, raw):
    df = spark.createDataFrame([(raw,)], "v binary")
    try:
        expected = raw.decode("utf-8")
    except UnicodeDecodeError:
        expected = str(raw)
    assert values(df.select(bytes_to_text(F.col("v")))) == [expected]


def test_bytes_to_text_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "v binary")
    assert values(df.select(bytes_to_text(F.col("v")))) == [None]


def test_sanitize_all_depths_and_idempotent(spark):
    nan, inf = float("nan"), float("inf")
    schema = "a double, b float, c array<double>, d map<string,double>, e struct<x: double, y: array<struct<z: double>>>, f string, g double"
    rows = [
        (nan, inf, [1.0, nan, -inf, None], {"k": inf, "l": 2.0}, (nan, [(inf,), (3.0,)]), "NaN", -0.0),
        (None, None, None, None, None, None, None),
        (1e308, 1.5, [], {}, (0.0, None), "", -1e308),
    ]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    once = sanitize(df)
    got = once.collect()
    assert got[0].asDict(recursive=True) == {
        "a": None, "b": None, "c": [1.0, None, None, None], "d": {"k": None, "l": 2.0},
        "e": {"x": None, "y": [{"z": None}, {"z": 3.0}]}, "f": "NaN", "g": 0.0,
    }
    assert all(v is None for v in got[1])
    assert got[2]["a"] == 1e308 and got[2]["c"] == [] and got[2]["e"]["y"] is None
    assert sanitize(once).collect() == got
    assert once.schema == df.schema


def test_epoch_limits(spark):
    given = [1700000000123, 1700000000, 10000000000, 10000000001, 253402300799000, 253402300799001, -5, None]
    df = spark.createDataFrame([(v,) for v in given], "v bigint").coalesce(1)
    got = values(df.select(epoch_ms_to_timestamp(F.col("v"), T.LongType()).cast("string")))
    assert got == [
        "2023-11-14 22:13:20.123", None, None, "1970-04-26 17:46:40.001", "9999-12-31 23:59:59", None, None, None,
    ]


def test_epoch_from_double_and_text(spark):
    df = spark.createDataFrame([(float("nan"), "2024-01-02 03:04:05"), (1.7e12, "soon")], "created_at double, end_time string")
    got = normalize_timestamps(df.coalesce(1)).collect()
    assert got[0]["created_at"] is None and got[0]["end_time"] == datetime(2024, 1, 2, 3, 4, 5)
    assert got[1]["created_at"].year == 2023 and got[1]["end_time"] is None


def test_boolean_values(spark):
    df = spark.createDataFrame([(v,) for v in ["0", "1", "true", "False", "x", "TRUE", None]], "is_on string").coalesce(1)
    assert values(normalize_booleans(df)) == [False, True, True, False, None, None, None]
    numbers = spark.createDataFrame([(0,), (1,), (2,), (None,)], "v int").coalesce(1)
    assert values(numbers.select(boolean_value(F.col("v"), T.IntegerType()))) == [False, True, None, None]


def test_names():
    assert all(map(is_time_name, ["created_at", "start_time", "timestamp"]))
    assert not any(map(is_time_name, ["time", "created_date", "timestamps"]))
    assert all(map(is_boolean_name, ["is_on", "auth_enabled", "api_supported", "success", "deprecated", "x_flaky", "x_active"]))
    assert not any(map(is_boolean_name, ["status", "enabled", "active"]))


def test_json(spark):
    df = spark.createDataFrame([([1, 2], {"a": 1}, (5,))], "l array<int>, m map<string,int>, s struct<x:int>")
    assert complex_to_json(df).first().asDict() == {"l": "[1,2]", "m": '{"a":1}', "s": '{"x":5}'}
    bad = spark.createDataFrame([('{"a":1}',), ("{",), (None,)], "config_json string").coalesce(1)
    parsed = json_to_variant(bad)
    assert isinstance(parsed.schema["config_json"].dataType, T.VariantType)
    assert values(parsed.select(F.col("config_json").isNull())) == [False, True, True]
    assert not math.isnan(1.0)
