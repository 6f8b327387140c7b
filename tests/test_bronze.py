from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from strata.operators.mapping import apply_mapping, array_to_object
from strata.plans.spec import SpecError
from strata.sinks.layers import write_bronze
from strata.sources.bronze import explode_payload, parse_lines, read_bronze, split_lines, with_ingestion_partitions
from strata.sources.files import build_manifest, config_inventory, scan_artifacts

LINES = [
    ('{"a":1,"b":null}', '{"a":1,"b":null}'),
    ('  {"a":{"b":[1,"}"]}}  ', '{"a":{"b":[1,"}"]}}'),
    ('{"a":1,"a":2}', '{"a":2}'),
    ('{"a":NaN}', '{"a":"NaN"}'),
    ("{}", "{}"),
    ('{"é":"ü "}', '{"é":"ü "}'),
    ('{"a":1} x', None),
    ('{"a":1}{"b":2}', None),
    ('{"a":1},{"b":2}', None),
    ('{"a":1}], junk', None),
    ("{'a':1}", None),
    ('{"a":1,"b":', None),
    ("[1]", None),
    ("5", None),
    ("null", None),
    ('{"a":007}', None),
]


def frame(spark, values, name="value"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string").coalesce(1)


def test_parse_lines(spark):
    parsed = parse_lines(frame(spark, [line for line, _ in LINES] + ["", " \t "]))
    got = [r[0] for r in parsed.select(F.to_json("row")).collect()]
    assert got == [want for _, want in LINES]
    good, bad = split_lines(parsed)
    assert (good.count(), bad.count()) == (6, 10)


def test_explode_payload(spark):
    payloads = ['[1,{"a":2},[3]]', '{"x":1}', "[]", " [null]"]
    rows = explode_payload(frame(spark, payloads, "payload"))
    assert [(r[0], r[1]) for r in rows.select("pos", F.to_json("row")).collect()] == [
        (0, "1"), (1, '{"a":2}'), (2, "[3]"), (0, '{"x":1}'), (0, "null"),
    ]
    with pytest.raises(Exception, match="not JSON"):
        explode_payload(frame(spark, ["[1] x"], "payload")).count()
    bad = explode_payload(frame(spark, ["[1] x", "[1]"], "payload"), on_error="quarantine")
    assert [(r.payload, r.pos) for r in bad.where("row IS NULL").collect()] == [("[1] x", 0)]


def test_array_to_object(spark):
    payloads = ['[[1,"x",true],[2,null]]', "[]"]
    rows = array_to_object(frame(spark, payloads, "payload"), "payload", ["a", "b"])
    assert [(r[0], r[1]) for r in rows.select("pos", F.to_json("row")).collect()] == [
        (0, '{"a":1,"b":"x"}'), (1, '{"a":2,"b":null}'),
    ]
    good, bad = array_to_object(
        frame(spark, ["[[1,2],[3],5,null]", '{"a":1}', "no"], "payload"), "payload", ["a", "b"], "quarantine"
    )
    assert good.count() == 1
    assert [r.error for r in bad.collect()] == [
        "too short: 1", "not a list: 2", "not a list: 3", "not a list: 0", "payload is not JSON",
    ]
    with pytest.raises(Exception, match="too short: 0"):
        array_to_object(frame(spark, ["[[1]]"], "payload"), "payload", ["a", "b"]).count()
    last = array_to_object(frame(spark, ["[[1,2,3]]"], "payload"), "payload", ["a", "b", "a"])
    assert last.select(F.to_json("row")).first()[0] == '{"a":3,"b":2}'


def test_mapping_types(spark):
    df = frame(spark, ["[[1]]"], "payload")
    assert apply_mapping(df, "payload", None).count() == 1
    assert apply_mapping(df, "payload", {"type": "array_to_object", "columns": ["a"]}).count() == 1
    for bad in ({"type": "other"}, {"type": "array_to_object", "columns": []}):
        with pytest.raises(SpecError):
            apply_mapping(df, "payload", bad)


def landed(spark, base, **options):
    rows = explode_payload(frame(spark, ['[{"i":1,"t":"é"},{"i":2,"t":null}]'], "payload")).withColumns(
        {"source": F.lit("s"), "entity": F.lit("e"), "run_id": F.lit("2024-01-05T00:x+y z")}
    )
    placed = with_ingestion_partitions(rows, F.expr("timestamp_ntz'2024-01-05 00:30:00'"))
    write_bronze(placed, base, **options)


def test_roundtrip_and_files(spark, tmp_path):
    base = str(tmp_path / "bronze")
    landed(spark, base)
    landed(spark, base, cluster=True)  # replaces the folder of the run
    back = read_bronze(spark, base)
    got = back.select("source", "entity", "ingestion_dt", "ingestion_hr", "run_id", F.to_json("row")).collect()
    assert sorted(tuple(r) for r in got) == [
        ("s", "e", "2024-01-05", "00", "2024-01-05T00:x+y z", '{"i":1,"t":"é"}'),
        ("s", "e", "2024-01-05", "00", "2024-01-05T00:x+y z", '{"i":2,"t":null}'),
    ]
    manifest = build_manifest(spark, base).first()
    import glob
    import hashlib

    files = glob.glob(f"{base}/**/*.txt", recursive=True)
    assert len(files) == 1 == manifest.n_files
    content = open(files[0], "rb").read()
    assert (manifest.bytes, manifest.sha256) == (len(content), hashlib.sha256(content).hexdigest())
    assert manifest.run_id == "2024-01-05T00:x+y z"
    found = scan_artifacts(spark, base, None).first()
    assert (found.bronze_files, found.silver_files, found.silver_parquet) == (1, 0, None)
    row = config_inventory(spark, base, "*.txt").first()
    assert (row.size_kb, row.sha256_12) == (round(len(content) / 1024, 2), hashlib.sha256(content).hexdigest()[:12])


def test_digest_of_many_files_depends_on_content_not_order(spark):
    from strata.sources.files import combined_digest

    def digest(rows):
        df = spark.createDataFrame(rows, "n string, d string").repartition(3)
        return df.agg(combined_digest(F.col("d"), F.col("n"))).first()[0]

    one = digest([("a", "1"), ("b", "2"), ("c", "3")])
    assert len(one) == 64
    assert one == digest([("c", "3"), ("a", "1"), ("b", "2")])
    assert one != digest([("a", "1"), ("b", "2"), ("c", "4")])
    assert digest([("a", "1"), ("b", "1")]) != digest([("a", "2"), ("b", "2")])


def test_malformed_line_fails_the_read(spark, tmp_path):
    path = str(tmp_path / "x")
    frame(spark, ['{"a":1}', "bad"]).write.text(path)
    with pytest.raises(Exception, match="malformed"):
        read_bronze(spark, path, ()).count()
    assert read_bronze(spark, path, (), on_error="quarantine").where("row IS NULL").first().value == "bad"
