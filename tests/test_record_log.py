"""The log of records: offsets, start positions, restarts, two-phase writes."""

import json

import pytest
from pyspark.sql import functions as F

from scrubline.session import shared_path
from scrubline.sources import append_log, log_source, read_log, record_log, stream_log
from scrubline.sources.streams import record_source


def _wire(spark, lo, hi, keyed=True):
    key = F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 7).cast("binary"))
    df = spark.range(lo, hi).select(F.col("id").cast("string").cast("binary").alias("value"),
                                    key.alias("key"))
    return df if keyed else df.drop("key")


def _values(df):
    return sorted(int(r.value) for r in df.collect())


def test_offsets_and_positions(spark, monkeypatch):
    monkeypatch.setattr(record_log, "SEGMENT_RECORDS", 40)
    log = shared_path(spark, "t_log")
    assert read_log(spark, log).collect() == []
    append_log(_wire(spark, 0, 500), log, partitions=3)
    middle = record_log.Log(log).latest()["ends"]
    append_log(_wire(spark, 500, 800), log, partitions=3)
    append_log(_wire(spark, 0, 0), log)
    rows = read_log(spark, log).collect()
    assert sorted(int(r.value) for r in rows) == list(range(800))
    for p in range(3):
        assert sorted(r.offset for r in rows if r.partition == p) == list(
            range(sum(r.partition == p for r in rows)))
    by_key = {}
    for r in rows:
        if r.key is not None:
            by_key.setdefault(bytes(r.key), set()).add(r.partition)
    assert all(len(v) == 1 for v in by_key.values()) and len(by_key) == 7
    assert {r.topic for r in rows} == {log.rsplit("/", 1)[1]}
    assert _values(read_log(spark, log, starting_offsets=middle)) == list(range(500, 800))
    assert _values(read_log(spark, log, ending_offsets=middle)) == list(range(500))
    one = {0: middle["0"] - 3, 1: 0, 2: 0}
    some = read_log(spark, log, starting_offsets=one, ending_offsets=middle).collect()
    assert sorted(r.offset for r in some if r.partition == 0) == list(
        range(middle["0"] - 3, middle["0"]))
    assert read_log(spark, log, starting_offsets="latest").collect() == []
    for bad in ({7: 0}, {0: 10**6}, {0: -1}):
        with pytest.raises(Exception, match="partition|offsets"):
            read_log(spark, log, starting_offsets=bad).collect()


def _drain(spark, log, out, ckpt, **kw):
    def each(df, i):
        df.select(F.col("value").cast("string").alias("v"), F.lit(i).alias("i")) \
            .write.mode("overwrite").parquet(f"{out}/b={i}")

    log_source(spark, log, **kw).writeStream.foreachBatch(each).option(
        "checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()


def test_checkpoint_wins_over_the_start_position(spark):
    log, out, ckpt = (shared_path(spark, x) for x in ("t_log", "t_out", "t_ckpt"))
    append_log(_wire(spark, 0, 50), log, partitions=2)
    _drain(spark, log, out, ckpt, starting_offsets="latest")
    append_log(_wire(spark, 50, 60, keyed=False), log)
    _drain(spark, log, out, ckpt, starting_offsets="earliest")
    append_log(_wire(spark, 60, 70), log)
    _drain(spark, log, out, ckpt, starting_offsets={0: 0})
    _drain(spark, log, out, ckpt)
    got = spark.read.parquet(out)
    assert sorted(int(r.v) for r in got.collect()) == list(range(50, 70))


def test_bounded_triggers_and_a_restart(spark):
    log, out, ckpt, prog = (shared_path(spark, x) for x in ("t_log", "t_out", "t_ckpt", "t_prog"))
    append_log(_wire(spark, 0, 100), log, partitions=3)
    sizes = {}  # by batch: one that was stopped before its commit comes again

    def each(df, i):
        rows = df.select(F.col("value").cast("string").alias("v")).collect()
        sizes[i] = len(rows)
        spark.createDataFrame(rows, "v string").write.mode("overwrite").parquet(f"{out}/b={i}")

    def run(total):
        q = log_source(spark, log, max_records_per_trigger=30, progress=prog).writeStream \
            .foreachBatch(each).option("checkpointLocation", ckpt) \
            .trigger(processingTime="0 seconds").start()
        try:
            for _ in range(600):
                if sum(sizes.values()) >= total or q.exception() is not None:
                    break
                q.awaitTermination(0.1)
        finally:
            q.stop()
        assert q.exception() is None

    run(100)
    append_log(_wire(spark, 100, 150), log)
    run(150)
    assert max(sizes.values()) <= 30 and sum(sizes.values()) == 150
    assert sorted(int(r.v) for r in spark.read.parquet(out).collect()) == list(range(150))
    with pytest.raises(Exception, match="progress"):
        log_source(spark, log, max_records_per_trigger=3).writeStream.format("noop").option(
            "checkpointLocation", shared_path(spark, "t_ckpt")).trigger(
            availableNow=True).start().awaitTermination()


def test_an_aborted_write_leaves_nothing_visible(spark):
    log = shared_path(spark, "t_log")
    append_log(_wire(spark, 0, 10), log)
    bad = _wire(spark, 10, 200).repartition(4).withColumn("value", F.when(
        F.col("value") != F.lit("150").cast("binary"), F.col("value")).otherwise(
        F.raise_error(F.lit("boom")).cast("binary")))
    with pytest.raises(Exception, match="boom"):
        append_log(bad, log)
    assert _values(read_log(spark, log)) == list(range(10))
    append_log(_wire(spark, 10, 20), log)
    assert _values(read_log(spark, log)) == list(range(20))


def test_a_replayed_batch_counts_once(spark):
    log, src, ckpt = (shared_path(spark, x) for x in ("t_log", "t_src", "t_ckpt"))
    for i in range(3):
        _wire(spark, i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    go = lambda c: stream_log(record_source(spark, src, schema, max_files_per_trigger=1), log, c,
                              writer="w", partitions=2, trigger="availableNow").awaitTermination()
    go(ckpt)
    assert _values(read_log(spark, log)) == list(range(30))
    before = record_log.Log(log).latest()
    assert before["applied"] == {"w": 2}
    # The same batches again, as after a crash between the log's commit and Spark's.
    go(shared_path(spark, "t_ckpt"))
    assert _values(read_log(spark, log)) == list(range(30))
    assert record_log.Log(log).latest() == before


def test_commit_documents_are_whole(spark):
    log = shared_path(spark, "t_log")
    for i in range(3):
        append_log(_wire(spark, i, i + 1, keyed=False), log)
    system, root = record_log.file_system(log)
    from pyarrow import fs

    names = [f.path for f in system.get_file_info(fs.FileSelector(f"{root}/commits"))]
    assert len(names) == 3
    docs = [json.loads(system.open_input_stream(n).read()) for n in sorted(names)]
    assert [d["number"] for d in docs] == [1, 2, 3]
    assert [s["base"] for d in docs for s in d["segments"]] == [0, 1, 2]
