from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from strata.functions import casts as ct
from strata.functions import text as tx
from strata.functions import times as tm


def column(spark, values, expression, ddl="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {ddl}").coalesce(1)
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_whitespace_is_that_of_python():
    assert set(tx.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip(spark):
    values = ["\t a b \n", " x　", "", "  ", " y\u0085", None]
    assert column(spark, values, tx.strip_ws) == [v.strip() if v is not None else None for v in values]


def test_float_text_is_python_repr(spark):
    values = [1.0, 12.5, 1e7, 12345678.5, 9999999999999998.0, 1e16, 1.5e16, 1e22, 1e-3, 1e-4, 1.25e-5, -2.5e-7, 0.0, -0.0,
              1e100, 123456789.123, float("nan"), float("inf"), float("-inf")]
    assert column(spark, values, tx.float_text, "double") == [repr(v) for v in values]


def test_zero_pad(spark):
    assert column(spark, ["0", "7", "12", "123"], tx.zero_pad) == ["00", "07", "12", "123"]


def test_placeholders(spark):
    values = ["{a}&{b}", "plain", "{ a }{a}{}", "{a", "}{b}"]
    assert column(spark, values, tx.placeholders) == [["a", "b"], [], ["a"], [], ["b"]]


@pytest.mark.parametrize(
    ("template", "params", "want", "missing"),
    [
        ("{a}-{b}", {"a": "1", "b": "2"}, "1-2", []),
        ("plain", {}, "plain", []),
        ("only { open", {}, "only { open", []),
        ("{a}", {"a": "{b}", "b": "no"}, "{b}", []),
        ("{a}", {"a": None}, "None", []),
        ("{{a}}{a}", {"a": "1"}, "{a}1", []),
        ("{a}{z}{y}", {"a": "1"}, None, ["y", "z"]),
        ("{ a }", {"a": "1"}, None, [" a "]),
    ],
)
def test_render(spark, template, params, want, missing):
    df = spark.createDataFrame([(template, params)], "t string, p map<string,string>")
    row = df.select(
        tx.render_template(F.col("t"), F.col("p")), tx.missing_template_values(F.col("t"), F.col("p"))
    ).first()
    assert (row[0], list(row[1])) == (want, missing)


@pytest.mark.parametrize(
    ("date", "hour", "want"),
    [
        ("2023-01-01", "01", 1672534800000),
        ("2023-01-01", "24", None),
        ("2023-02-30", "00", None),
        ("2023-1-1", "00", None),
        ("2023-01-01", "1", None),
        ("20xx-01-01", "01", None),
    ],
)
def test_window(spark, date, hour, want):
    df = spark.createDataFrame([(date, hour)], "d string, h string")
    start, end = tm.window_ms(F.col("d"), F.col("h"), 60)
    row = df.select(start, end).first()
    assert tuple(row) == (want, None if want is None else 1672538400000)


def test_times_ignore_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS n, timestamp'2024-03-10 02:30:00Z' AS t")
        for name in ("n", "t"):
            ntz = tm.utc_ntz(F.col(name), df.schema[name].dataType)
            row = df.select(tm.epoch_ms(ntz), tm.day_text(ntz), tm.hour_text(ntz)).first()
            assert tuple(row) == (1710037800000, "2024-03-10", "02")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# JSON text -> string, int64, float64, boolean
JSON_CASES = [
    ("1", "1", 1, 1.0, True),
    ("0", "0", 0, 0.0, False),
    ("-3", "-3", -3, -3.0, True),
    ("12.7", "12.7", 12, 12.7, True),
    ("-12.7", "-12.7", -12, -12.7, True),
    ("5.0", "5.0", 5, 5.0, True),
    ("1e7", "10000000.0", 10000000, 1e7, True),
    ("0.00001", "1e-05", 0, 1e-05, True),
    ("true", "True", 1, 1.0, True),
    ("false", "False", 0, 0.0, False),
    ("null", None, None, None, None),
    ('"x"', "x", None, None, False),
    ('"12"', "12", 12, 12.0, False),
    ('"1"', "1", 1, 1.0, True),
    ('" 12 "', " 12 ", 12, 12.0, False),
    ('" 12　"', " 12　", 12, 12.0, False),
    ('"12.7"', "12.7", None, 12.7, False),
    ('"1_000"', "1_000", None, None, False),
    ('"1d"', "1d", None, None, False),
    ('"0x1p3"', "0x1p3", None, None, False),
    ('"1e3"', "1e3", None, 1000.0, False),
    ('".5"', ".5", None, 0.5, False),
    ('"-Inf"', "-Inf", None, float("-inf"), False),
    ('"YES"', "YES", None, None, True),
    ('"y"', "y", None, None, True),
    ('"t"', "t", None, None, False),
    ('" true"', " true", None, None, False),
    ('"True"', "True", None, None, True),
    ('"true"', "true", None, None, True),
    ("[1]", "[1]", None, None, False),
    ('{"a":1}', '{"a":1}', None, None, False),
    ("9223372036854775808", "9223372036854775808", None, 9223372036854775808.0, True),
]


@pytest.mark.parametrize("path", ["$", "$.v"])
def test_json_casts(spark, path):
    lines = [(i, c[0] if path == "$" else f'{{"v":{c[0]}}}') for i, c in enumerate(JSON_CASES)]
    df = spark.createDataFrame(lines, "i int, x string").select("i", F.parse_json("x").alias("v"))
    value = ct.Json(F.col("v"), path)
    rows = df.select("i", *[ct.cast_json(value, t) for t in ("string", "int64", "float64", "boolean")]).collect()
    for row in rows:
        assert tuple(row[1:]) == JSON_CASES[row[0]][1:], JSON_CASES[row[0]]


def test_logical_types(spark):
    df = spark.sql("SELECT parse_json('1700000000123') AS ms, parse_json('\"2024-02-30\"') AS d, '2024-02-29' AS t")
    row = df.select(
        F.unix_millis(ct.cast_json(ct.Json(F.col("ms")), "timestamp_ms", True)),
        ct.cast_json(ct.Json(F.col("d")), "date", True),
        ct.cast_typed(F.col("t"), T.StringType(), "date", True).cast("string"),
        F.unix_seconds(ct.cast_typed(F.lit(5), T.IntegerType(), "timestamp_s", True)),
    ).first()
    assert tuple(row) == (1700000000123, None, "2024-02-29", 5)


def test_typed_casts(spark):
    df = spark.sql("SELECT 12.7D AS d, 1e30D AS big, true AS b, date'2024-01-05' AS day, 7 AS i, double('NaN') AS nan")
    types = {f.name: f.dataType for f in df.schema.fields}

    def cast(name, logical):
        return df.select(ct.cast_typed(F.col(name), types[name], logical)).first()[0]

    assert cast("d", "int64") == 12
    assert cast("big", "int64") is None
    assert cast("nan", "int64") is None
    assert cast("b", "string") == "True"
    assert cast("b", "int64") == 1
    assert cast("i", "float64") == 7.0
    assert cast("i", "boolean") is True
    assert cast("nan", "boolean") is True
    assert cast("day", "date") == "2024-01-05"
    with pytest.raises(TypeError):
        cast("day", "int64")
    with pytest.raises(ValueError):
        cast("i", "decimal")
