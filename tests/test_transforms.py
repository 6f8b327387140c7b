from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from strata.operators.transforms import apply_transforms, check_rows, conform, split_valid
from strata.plans.spec import Schema, SpecError
from strata.sources.bronze import parse_lines


def rows(spark, *lines, extra=None):
    df = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    if extra:
        df = df.withColumns(extra)
    return parse_lines(df).drop("value")


def schema(columns, transforms):
    return Schema(1, "x", "s", "e", columns=columns, transforms=transforms)


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_case_distinct_keys(spark):
    spec = schema(
        {"maker": "boolean", "match": "boolean"},
        {"keep": ["m", "M"], "rename": {"m": "maker", "M": "match"}, "cast": {"maker": "boolean", "match": "boolean"}},
    )
    assert dicts(apply_transforms(rows(spark, '{"m":true,"M":false}'), spec)) == [{"maker": True, "match": False}]


def test_rename_overwrites_only_where_the_old_key_is_present(spark):
    spec = schema({"b": "string"}, {"keep": ["a", "b"], "rename": {"a": "b"}, "required": ["b"]})
    lines = ['{"a":"A","b":"B"}', '{"b":"B"}', '{"a":null,"b":"B"}', "{}"]
    flagged = check_rows(rows(spark, *lines), spec).flagged().collect()
    assert [(r.b, r.reasons) for r in flagged] == [("A", []), ("B", []), (None, []), (None, ["missing:b"])]


def test_typed_rename_chain_and_overwrite(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c")
    assert dicts(apply_transforms(df, {"rename": {"a": "b", "b": "d"}})) == [{"c": 3, "d": 1}]
    assert apply_transforms(df, {"rename": {"a": "b"}}).columns == ["b", "c"]


def test_keep_order_and_empty_keep(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c")
    assert apply_transforms(df, {"keep": ["c", "zz", "a"]}).columns == ["c", "a"]
    assert apply_transforms(df, {"keep": []}).columns == ["a", "b", "c"]


def test_add_columns(spark):
    spec = {
        "rename": {"a": "b"},
        "add_columns": [
            {"name": "p", "from_param": "date"},
            {"name": "q", "from_param": "absent"},
            {"name": "c", "from_column": "b"},
            {"name": "d", "from_column": "c"},
            {"name": "e", "from_column": "a"},
            {"name": "b", "literal": 2.5},
        ],
    }
    got = dicts(apply_transforms(spark.sql("SELECT 1 AS a"), spec, {"date": "2024-01-05"}))
    assert got == [{"b": 2.5, "p": "2024-01-05", "q": None, "c": 1, "d": 1, "e": None}]


def test_params_per_run(spark):
    params = F.create_map(F.lit("sym"), F.lit(" BTC "))
    df = rows(spark, '{"v":1}', extra={"run_id": F.lit("r"), "params": params})
    spec = schema(
        {"v": "int64", "symbol": "string", "no": "string"},
        {
            "keep": ["v"],
            "add_columns": [{"name": "symbol", "from_param": "sym"}, {"name": "no", "from_param": "zz"}],
            "trim": ["symbol"],
        },
    )
    got = dicts(apply_transforms(df, spec, params_col="params"))
    assert got == [{"run_id": "r", "v": 1, "symbol": "BTC", "no": None}]


def test_null_if_and_fillna(spark):
    df = spark.sql("SELECT * FROM VALUES ('N/A', 5, true, 1.0D), ('x', 7, false, 2.0D), (NULL, NULL, NULL, NULL) t(s, i, b, d)")
    spec = {
        "lower": ["s"],
        "null_if": {"s": ["n/a", 5], "i": [5.0, "7"], "b": [1], "d": [True, float("nan")], "absent": ["x"]},
        "fillna": {"s": "x", "i": 0, "new": "n"},
    }
    got = apply_transforms(df, spec).collect()
    assert [tuple(r) for r in got] == [("x", 0, None, None, "n"), ("x", 7, False, 2.0, "n"), ("x", 0, None, None, "n")]
    with pytest.raises(SpecError):
        apply_transforms(df, {"fillna": {"i": "zero"}})
    with pytest.raises(SpecError):
        apply_transforms(df, {"fillna": {"i": True}})


def test_null_if_on_uncast_json_compares_json_types(spark):
    spec = schema({"v": "string"}, {"keep": ["v"], "null_if": {"v": [5, "x", True]}})
    got = apply_transforms(rows(spark, '{"v":5}', '{"v":"5"}', '{"v":"x"}', '{"v":true}', '{"v":"True"}'), spec)
    assert [r.v for r in got.collect()] == [None, "5", None, None, "True"]


def test_text_keys_leave_other_types_alone(spark):
    df = spark.sql("SELECT ' A ' AS s, 5 AS i")
    assert dicts(apply_transforms(df, {"trim": ["s", "i"], "lower": ["s"], "upper": ["i"]})) == [{"s": "a", "i": 5}]
    spec = schema({"v": "string"}, {"keep": ["v"], "lower": ["v"]})
    assert [r.v for r in apply_transforms(rows(spark, '{"v":true}', '{"v":"TRUE"}'), spec).collect()] == ["True", "true"]


def test_required_and_non_null(spark):
    spec = schema(
        {"a": "int64", "b": "string", "c": "string"},
        {
            "keep": ["a", "b"], "cast": {"a": "int64"}, "fillna": {"b": "-"}, "add_columns": [{"name": "c", "literal": "k"}],
            "required": ["a", "b", "c"], "non_null": ["a", "b"],
        },
    )
    lines = ['{"a":1,"b":"x"}', '{"a":1}', '{"a":null,"b":"x"}', '{"b":"x"}', '{"a":"?","b":null}']
    flagged = check_rows(rows(spark, *lines), spec).flagged().collect()
    assert [r.reasons for r in flagged] == [[], [], ["null:a"], ["missing:a", "null:a"], ["cast:a"]]
    good, bad = split_valid(rows(spark, *lines), spec)
    assert [(r.a, r.b, r.c) for r in good.collect()] == [(1, "x", "k"), (1, "-", "k")]
    assert [r.input for r in bad.collect()] == ['{"a":null,"b":"x"}', '{"b":"x"}', '{"a":"?","b":null}']


def test_failure_survives_column_pruning(spark):
    spec = schema({"a": "int64", "b": "string"}, {"keep": ["a", "b"], "non_null": ["a"]})
    df = apply_transforms(rows(spark, '{"b":"x"}'), spec)
    for action in (df.count, df.select("b").collect):
        with pytest.raises(Exception, match="null:a"):
            action()
    typed = apply_transforms(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), {"non_null": ["b"]})
    with pytest.raises(Exception, match="null:b"):
        typed.count()


def test_absent_typed_columns(spark):
    df = spark.sql("SELECT 1 AS a")
    flagged = check_rows(df, {"required": ["a", "z"], "non_null": ["y"], "cast": {"w": "int64"}}).flagged().first()
    assert flagged.reasons == ["missing:z", "null:y"]


def test_malformed_rows_are_rejected_with_their_line(spark):
    spec = schema({"a": "int64"}, {"keep": ["a"]})
    parsed = parse_lines(spark.createDataFrame([('{"a":1}',), ("{bad",)], "value string"))
    good, bad = split_valid(parsed, spec)
    assert [r.a for r in good.collect()] == [1]
    assert [(r.input, r.reasons) for r in bad.collect()] == [("{bad", ["malformed"])]


def test_conform(spark):
    df = spark.sql("SELECT '5' AS a, 1.0D AS extra, true AS b")
    got = conform(df, {"b": "string", "absent": "float64", "a": "int64"})
    assert got.columns == ["b", "absent", "a"]
    assert [tuple(r) for r in got.collect()] == [("True", None, 5)]
    assert conform(spark.sql("SELECT 'x' AS a"), {"a": "int64"}, on_error="quarantine").count() == 0


def test_spec_errors(spark):
    df = spark.sql("SELECT 1 AS a, date'2024-01-01' AS d")
    with pytest.raises(SpecError):
        apply_transforms(df, {"cast": {"a": "decimal"}})
    with pytest.raises(SpecError):
        apply_transforms(df, {"cast": {"d": "int64"}})
    with pytest.raises(SpecError):
        apply_transforms(df, {"add_columns": [{"name": "x"}]})
    with pytest.raises(SpecError):
        apply_transforms(rows(spark, "{}"), {"keep": ["a"]})
    with pytest.raises(SpecError, match="case"):
        apply_transforms(rows(spark, "{}"), schema({"m": "string", "M": "string"}, {}))


def test_empty_lists_and_keys_with_odd_names(spark):
    spec = schema({"x": "int64", "y": "int64"}, {"rename": {"a.b": "x", "it's": "y"}})
    assert dicts(apply_transforms(rows(spark, '{"a.b":1,"it\'s":2}'), spec)) == [{"x": 1, "y": 2}]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_one_scan_and_no_python(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"a":1,"b":"x"}',)], "value string").write.text(path)
    spec = schema({"a": "int64", "b": "string"}, {"cast": {"a": "int64"}, "trim": ["b"], "non_null": ["a"]})
    text = plan(check_rows(parse_lines(spark.read.text(path)), spec).accepted())
    assert text.count("FileScan") == 1
    assert text.count("parseJson") == 1  # filters do not parse again
    assert "Python" not in text and "Exchange" not in text
