from __future__ import annotations

import random

from strata.operators.keys import deduplicate, unique_key_violations

DDL = "k string, t int, v int"


def data(spark, n=3000):
    """A third of all rows share one key; keys and times may be null."""
    rng = random.Random(7)
    keys = ["hot"] * (n // 3) + [rng.choice(["a", "b", "c", None]) for _ in range(n - n // 3)]
    rows = [(k, rng.choice([None, *range(50)]), rng.randrange(100)) for k in keys]
    return rows, spark.createDataFrame(rows, DDL).repartition(5)


def nulls_low(value):
    return (value is not None, value or 0)


def brute(rows, pick):
    best = {}
    for row in rows:
        rank = (nulls_low(row[1]), nulls_low(row[2]))
        if row[0] not in best or pick(rank, best[row[0]][0]):
            best[row[0]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


def test_deduplicate_against_brute_force(spark):
    rows, df = data(spark)
    last = deduplicate(df, ["k"], ["t"])
    assert last.columns == ["k", "t", "v"]
    assert sorted((tuple(r) for r in last.collect()), key=repr) == brute(rows, lambda a, b: a > b)
    first = deduplicate(df, ["k"], ["t"], keep="first")
    assert sorted((tuple(r) for r in first.collect()), key=repr) == brute(rows, lambda a, b: a < b)


def test_deduplicate_reduces_before_the_shuffle(spark):
    _, df = data(spark)
    text = deduplicate(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text and "Window" not in text


def test_deduplicate_without_order_and_with_maps(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2, map('a', 1)), (1, 3, map('b', 2)) t(k, v, m)")
    assert [(r.k, r.v, r.m) for r in deduplicate(df, ["k"], []).collect()] == [(1, 3, {"b": 2})]
    assert deduplicate(df.select("k"), ["k"]).count() == 1


def test_unique_key_violations(spark):
    rows, df = data(spark)
    want = {}
    for k, t, _ in rows:
        want[k, t] = want.get((k, t), 0) + 1
    got = {(r.k, r.t): r.n_rows for r in unique_key_violations(df, ["k", "t"]).collect()}
    assert got == {key: n for key, n in want.items() if n > 1}
