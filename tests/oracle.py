"""Run example queries and compare each with its SQL on DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, name, function, sql, sf_dir):
    """None where equal, else what differs."""
    df = function(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: {[g for g in got if g not in set(want)][:3]} / {[w for w in want if w not in set(got)][:3]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else None


def main() -> None:
    from conftest import make_spark
    from strata.queries import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2:]
    spark, con = make_spark(), connect(sf_dir)
    for name, function in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, function, ORACLES[name], sf_dir)
            else:
                problem = f"no SQL, {function(spark, sf_dir).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
