"""The ledger of micro-batches, one job per batch, and keys under a collation."""

import pytest
from pyspark.sql import functions as F

from scrubline.functions.json import encode_json
from scrubline.operators import analysis as A
from scrubline.operators import cleaning as C
from scrubline.session import shared_path
from scrubline.sources.streams import kafka_source, record_source
from scrubline.streaming import (BatchLedger, ledger_against_sink, read_ledger, read_sink,
                                 run_ingest, write_batch)

CI = "UNICODE_CI_AI"


def test_ledger_agrees_with_the_sink_after_a_replay(spark):
    topic, sink, ckpt, path = (shared_path(spark, x) for x in ("t", "s", "c", "l"))
    rows = spark.range(90).select(F.col("id").cast("string"))
    assert read_ledger(spark, path).count() == 0
    for part in range(3):
        encode_json(rows.filter(F.col("id") % 3 == part)).coalesce(1).write.mode("append") \
            .parquet(topic)
    schema = spark.read.parquet(topic).schema
    ledger = BatchLedger(spark, path, queries=("ledgered",))
    spark.streams.addListener(ledger)
    try:
        for fail in (True, False):
            def check(df, fail=fail):
                return df.withColumn("id", F.when(F.col("id") == "1", F.raise_error(
                    F.lit("boom")).cast("string")).otherwise(F.col("id"))) if fail else df

            q = run_ingest(record_source(spark, topic, schema, max_files_per_trigger=1), sink, ckpt,
                           schema=rows.schema, transform=check, trigger="availableNow",
                           query_name="ledgered")
            if fail:
                with pytest.raises(Exception, match="boom"):
                    q.awaitTermination()
            else:
                q.awaitTermination()
            ledger.flush()
    finally:
        spark.streams.removeListener(ledger)
    entries = read_ledger(spark, path)
    got = entries.orderBy("batch_id").collect()
    assert [r["rows"] for r in got] == [30, 30, 30] and len({r.query_id for r in got}) == 1
    assert all(r.name == "ledgered" and r.started_at and r.sources[0].end_offset for r in got)
    written = spark.read.parquet(sink)
    assert ledger_against_sink(entries, written).count() == 0
    assert ledger_against_sink(entries, written.filter("batch_id > 0")).count() == 1


def test_one_job_per_batch(spark):
    sc, sink = spark.sparkContext, shared_path(spark, "t_one_job")
    for df, n in ((spark.range(100), 100), (spark.range(0), 0)):
        sc.setJobGroup(f"one-job-{n}", "")
        assert write_batch(df, n, sink) == n
        jobs = sc.statusTracker().getJobIdsForGroup(f"one-job-{n}")
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) == 1
    assert read_sink(spark, sink).count() == 100
    empty = spark.createDataFrame([], "id long, v string")
    nothing = shared_path(spark, "t_nothing")
    assert write_batch(empty, 0, nothing) == 0
    got = read_sink(spark, nothing, empty.schema)
    assert got.count() == 0 and set(empty.columns) <= set(got.columns)
    with pytest.raises(ValueError, match="no rows yet"):
        read_sink(spark, nothing)


def test_keys_compare_by_a_collation(spark):
    df = spark.createDataFrame(
        [("abc", 1, "x"), ("ABC", 2, "x"), ("Ábc", 4, None), ("xyz", 8, None), ("XYZ", 16, "q"),
         (None, 32, "n"), (None, 64, None)], "k string, n int, v string")
    total = A.total_by(df, "k", "n", collation=CI)
    assert sorted(map(tuple, total.collect()), key=str) == sorted(
        [("ABC", 7), ("XYZ", 24), (None, 96)], key=str)
    assert A.total_by(df, "k", "n").count() == 6  # off by default
    kept = C.dedupe(df, "k", order="-n", collation=CI)
    assert kept.columns == df.columns
    assert sorted(r.n for r in kept.collect()) == [4, 16, 64]
    whole = df.select("k").union(df.select("k"))
    assert sorted((r.k for r in C.dedupe(whole, collation=CI).collect()), key=str) == sorted(
        ["ABC", "XYZ", None], key=str)
    numbered = C.number_duplicates(df, "k", order="n", collation=CI)
    assert sorted((r.n, r.row_num) for r in numbered.collect()) == [
        (1, 1), (2, 2), (4, 3), (8, 1), (16, 2), (32, 1), (64, 2)]
    filled = C.fill_from_peers(df, "k", "v", collation=CI)
    assert {r.n: r.v for r in filled.collect()} == {1: "x", 2: "x", 4: "x", 8: "q", 16: "q",
                                                    32: "n", 64: None}
    top = A.top_n_per_group(df, "k", "n", n=1, collation=CI)
    assert sorted((r.k, r.n, r.ranking) for r in top.collect()) == [("XYZ", 16, 1), ("Ábc", 4, 1)]
    with pytest.raises(ValueError, match="no collation"):
        C.dedupe(df, "k", order="n", wide=True, collation=CI)


def test_kafka_options_reach_the_reader(spark, monkeypatch):
    """The start position and bounds, on the reader as it is built (no broker)."""
    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return "stream"

    class Session:
        readStream = Reader()

    assert kafka_source(Session(), "h:1", "t", starting_offsets='{"t":{"0":5}}', group_id="g",
                        max_offsets_per_trigger=10, failOnDataLoss="false") == "stream"
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "t",
                    "startingOffsets": '{"t":{"0":5}}', "kafka.group.id": "g",
                    "maxOffsetsPerTrigger": "10", "failOnDataLoss": "false"}
    kafka_source(Session(), "h:1", "t")
    assert seen["startingOffsets"] == "latest"
