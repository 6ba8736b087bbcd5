"""Lossless keyed duplicate removal: no row lost, none twice, state measured."""

import pytest
from pyspark.sql import functions as F

from scrubline.session import shared_path
from scrubline.sources.streams import record_source
from scrubline.streaming import SeenKeys, dedupe_lossless, read_sink, seen, write_batch


def _rows(spark, lo, hi, batch):
    key = F.when(F.col("id") % 97 != 5, F.col("id"))
    return spark.range(lo, hi).select(key.alias("k"), (F.col("id") % 3).alias("Part"),
                                      F.lit(batch).alias("batch"), F.lit("x").alias("_maybe"), F.lit(1).alias("_BITMAP"), F.lit(2).alias("_at"))


def _keys(rows):
    return sorted((str(r.k), r.Part) for r in rows)


@pytest.mark.parametrize("full", [3000, 200])
def test_repeats_any_number_of_batches_apart(spark, monkeypatch, full):
    monkeypatch.setattr(seen, "FULL", full)
    monkeypatch.setattr(seen, "FANOUT", 3)
    known = SeenKeys(spark, shared_path(spark, "t_seen"), ["k", "part"], segments=2)
    done = set()
    for batch in range(8):
        # Each batch repeats all of the first and half of the one before.
        df = _rows(spark, 0, 100, batch).union(_rows(spark, batch * 100, batch * 100 + 200, batch))
        want = {(str(r.k), r.Part) for r in df.collect()} - done
        new = known.unseen(df)
        rows = new.collect()
        assert new.columns == df.columns and _keys(rows) == sorted(want)
        done |= want
        doc = known.add(spark.createDataFrame(rows, df.schema), "w", batch)
        assert known.add(df, "w", batch) == doc  # a replay
        assert doc["n"] == len(done)
    assert len(doc["runs"]) <= 2 * 3 and (doc["segments"] > 2) == (full == 200)


def test_a_new_key_needs_no_look_at_the_keys(spark, monkeypatch):
    known = SeenKeys(spark, shared_path(spark, "t_seen"), "k")
    known.add(spark.range(20_000).select(F.col("id").alias("k")), "w", 0)
    fresh = spark.range(10**6, 10**6 + 5000).select(F.col("id").alias("k"))
    marked = known._marked(fresh, known.state(), "maybe")
    assert marked.filter("maybe").count() < 5000 // 20  # few are looked up in vain
    doc = known.state()
    bits = spark.read.parquet(*[f"{known.root}/{r['index']}" for r in doc["runs"]]).agg(
        F.sum(F.length("_bitmap"))).collect()[0][0]
    assert bits <= 2.8 * doc["n"] + 4096 * 16  # index bytes per key
    old = spark.range(100, 200).select(F.col("id").alias("k"))
    assert known._marked(old, doc, "maybe").filter("not maybe").count() == 0  # none is missed
    monkeypatch.setattr(SeenKeys, "_known", None)
    assert known.unseen(fresh.filter("k % 977 = 3").limit(0)).collect() == []


def test_stream_loses_no_late_row_and_survives_a_failing_sink(spark):
    folder, ckpt = shared_path(spark, "t_in"), shared_path(spark, "t_ckpt")
    sink, store = shared_path(spark, "t_sink"), shared_path(spark, "t_store")
    schema = "k long, ts timestamp, v string"
    days = [(5, "2024-01-05"), (1, "2024-01-01"), (9, "2024-01-09")]  # the second is late
    for i, (k, day) in enumerate([*days, *days]):
        spark.createDataFrame([(k, day, f"f{i}"), (100 + i, day, "own")], "k long, d string, v string") \
            .select("k", F.to_timestamp("d").alias("ts"), "v").coalesce(1) \
            .write.mode("append").parquet(folder)
    src = lambda: record_source(spark, folder, spark.createDataFrame([], schema).schema,
                                max_files_per_trigger=1)
    failed = []

    def fails_once(rows, batch):
        write_batch(rows, batch, sink)
        if batch == 2 and not failed:
            failed.append(1)
            raise RuntimeError("after the write, before the keys are noted")

    with pytest.raises(Exception, match="before the keys"):
        dedupe_lossless(src(), "k", store, ckpt, fails_once,
                        trigger="availableNow").awaitTermination()
    dedupe_lossless(src(), "k", store, ckpt, fails_once, trigger="availableNow").awaitTermination()
    got = read_sink(spark, sink).collect()
    assert sorted(r.k for r in got) == [1, 5, 9, 100, 101, 102, 103, 104, 105]
    assert SeenKeys(spark, store, "k").state()["n"] == 9
