from __future__ import annotations

from pyspark.sql import functions as F
from strata.operators.transforms import apply_transforms
from strata.plans.pipeline import read_run_log
from strata.plans.spec import Schema
from strata.sources.bronze import parse_lines, read_bronze
from strata.sources.silver import read_silver
from strata.streaming import streams as st
from strata.streaming.streams import BATCH_BRONZE, bronze_stream, deduplicated, stream_bronze, stream_silver

MESSAGE = "source string, entity string, run_id string, payload string, ts timestamp_ntz"
SPEC = Schema(1, "t", "s", "e", {"id": "int64"}, {"keep": ["i"], "rename": {"i": "id"}, "cast": {"id": "int64"}})


def send(spark, folder, *messages):
    rows = spark.createDataFrame([("s", "e", run, text) for run, text in messages], "source string, entity string, run_id string, payload string")
    rows.withColumn("ts", F.expr("timestamp_ntz'2024-01-05 10:00:00'")).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(MESSAGE).parquet(folder)


def test_streams_equal_the_batch_and_do_not_repeat(spark, tmp_path):
    base = str(tmp_path)
    requests = None

    def run():
        stream_bronze(
            stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/c1", "ts",
            log_path=f"{base}/log", quarantine=f"{base}/qb",
        ).awaitTermination()
        stream_silver(
            bronze_stream(spark, f"{base}/bronze"), SPEC, f"{base}/silver", f"{base}/c2",
            requests=requests, quarantine=f"{base}/qs", log_path=f"{base}/log",
        ).awaitTermination()

    def rows():
        silver = read_silver(spark, f"{base}/silver", SPEC, extra_partitions=["batch_id"])
        return sorted((r.run_id, r.id) for r in silver.collect())

    send(spark, f"{base}/in", ("a", '[{"i":1},{"i":"x"}]'), ("b", "oops"))
    run()
    assert rows() == [("a", 1)]
    # The same run goes on in a later batch, and what was there stays.
    send(spark, f"{base}/in", ("a", '[{"i":2}]'), ("c", '{"i":3}'))
    run()
    run()
    assert rows() == [("a", 1), ("a", 2), ("c", 3)]
    bronze = read_bronze(spark, f"{base}/bronze", BATCH_BRONZE)
    good = bronze.where(F.try_variant_get("row", "$.i", "bigint").isNotNull()).select("run_id", "row")
    assert sorted((r.run_id, r.id) for r in apply_transforms(good, SPEC).collect()) == rows()
    assert [r.reasons for r in spark.read.parquet(f"{base}/qb").collect()] == [["payload is not JSON"]]
    assert [(r.input, r.reasons) for r in spark.read.parquet(f"{base}/qs").collect()] == [('{"i":"x"}', ["cast:id"])]
    statuses = [(r.run_id, r.status) for r in read_run_log(spark, f"{base}/log").collect()]
    assert statuses.count(("a", "SILVER_WRITTEN")) == 2


def test_a_batch_played_again_replaces_itself(spark, tmp_path):
    from strata.sinks.layers import write_silver

    for batch, values in (("0", [1, 2]), ("1", [3]), ("1", [3])):
        df = spark.createDataFrame([("s", "e", "r", v, batch) for v in values], "source string, entity string, run_id string, id long, batch_id string")
        write_silver(df, str(tmp_path), SPEC, extra_partitions=["batch_id"])
    got = read_silver(spark, str(tmp_path), SPEC, extra_partitions=["batch_id"])
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_params_of_each_run(spark, tmp_path):
    base = str(tmp_path)
    spec = Schema(1, "t", "s", "e", {"id": "int64", "sym": "string"}, {"rename": {"i": "id"}, "add_columns": [{"name": "sym", "from_param": "sym"}]}, ("sym",))
    send(spark, f"{base}/in", ("a", '{"i":1}'), ("b", '{"i":2}'))
    stream_bronze(stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/c1", "ts").awaitTermination()
    requests = spark.createDataFrame([("s", "e", r, {"sym": r.upper()}) for r in "ab"], "source string, entity string, run_id string, params map<string,string>")
    stream_silver(bronze_stream(spark, f"{base}/bronze"), spec, f"{base}/silver", f"{base}/c2", requests=requests).awaitTermination()
    got = read_silver(spark, f"{base}/silver", spec, extra_partitions=["batch_id"])
    assert sorted((r.id, r.sym) for r in got.collect()) == [(1, "A"), (2, "B")]


def test_messages_land_once_and_streams_keep_apart(spark, tmp_path):
    base = str(tmp_path)

    def land(checkpoint):
        stream_bronze(stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/{checkpoint}", "ts", landed=f"{base}/landed", quarantine=f"{base}/q").awaitTermination()
        return sorted(r.run_id for r in read_bronze(spark, f"{base}/bronze", BATCH_BRONZE).collect())

    send(spark, f"{base}/in", ("a", '{"i":1}'), ("a", '{"i":1}'), ("b", "oops"))
    assert land("c1") == ["a"]
    send(spark, f"{base}/in", ("a", '{"i":1}'), ("c", '{"i":3}'))
    assert land("c1") == ["a", "c"]
    # Another checkpoint begins with batch 0 again and is given all messages again.
    assert land("c2") == ["a", "c"]
    assert spark.read.parquet(f"{base}/q").count() == 1


def test_a_small_batch_reads_only_its_buckets(spark, tmp_path):
    """What a batch reads of the landed keys goes by its own keys: folders and filters for scans, Bloom filters in the files."""
    landed = str(tmp_path / "landed")
    def batch(first, last):
        return st._with_message_key(spark.range(first, last).selectExpr("'s' AS source", "'e' AS entity", "concat('r', id) AS run_id", "concat('i', id) AS payload"))

    for n in range(3):
        st._write_landed(batch(1000 * n, 1000 * n + 1000).select("_message", "_bucket"), landed, f"q-{n}")
    one = batch(5, 6)
    known = st._known_keys(spark, landed, one, "q-9")
    plan = known._jdf.queryExecution().executedPlan().toString()
    folders, pushed = plan.split("PartitionFilters: ")[1].split("PushedFilters: ")
    assert "bucket" in folders and "_message" in pushed.split("ReadSchema")[0]
    assert known.count() == 1 and st._known_keys(spark, landed, one, "q-0").count() == 0
    many = st._known_keys(spark, landed, batch(0, 50), "q-9")
    assert many.count() > 50 and "bucket" in many._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
    file = next((tmp_path / "landed").rglob("*.parquet"))
    metadata = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path(str(file)))
    assert metadata.getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0
    files = len(list((tmp_path / "landed").rglob("*.parquet")))
    for _ in range(2):
        st.compact_landed(spark, landed)
        assert len(list((tmp_path / "landed").rglob("*.parquet"))) < files
        assert spark.read.parquet(landed).select("_message").distinct().count() == 3000
        assert sorted({r.batch_id for r in spark.read.parquet(landed).select("batch_id").collect() if r.batch_id.startswith("q-")}) == ["q-2"]
        assert st._not_landed(batch(900, 3100).drop("_message", "_bucket"), landed, "q-9").count() == 100


def test_quarantine_of_two_datasets(spark, tmp_path):
    from strata.sinks.layers import write_quarantine

    for source in ("x", "y"):
        for layer in ("bronze", "silver"):
            write_quarantine(spark.createDataFrame([(source, "e", "r", "in")], "source string, entity string, run_id string, input string"), str(tmp_path), "w-0", layer=layer)
    assert spark.read.parquet(str(tmp_path)).count() == 4


def test_redelivered_messages(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/in", ("a", "1"), ("a", "1"), ("b", "2"))
    unique = deduplicated(stream(spark, f"{base}/in"), ["run_id"], "ts")
    query = (
        unique.select("run_id").writeStream.format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.run_id for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b"]


def test_parse_lines_over_a_stream(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([('{"i":1}',)], "value string").write.text(f"{base}/in")
    parsed = parse_lines(spark.readStream.text(f"{base}/in"))
    assert parsed.isStreaming and "row" in parsed.columns
