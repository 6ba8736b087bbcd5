"""The keyed table: out-of-order updates, versions, compaction, replays."""

import random

import pytest
from pyspark.sql import functions as F

from scrubline.session import shared_path
from scrubline.sources.keyed_table import Conflict, KeyedTable
from scrubline.sources.streams import record_source
from scrubline.sources.versions import Taken, Versions
from scrubline.streaming import read_sink, run_upsert

ROWS = "k string, n int, t long, v string, _bucket string, _seq int"


def _df(spark, rows):
    return spark.createDataFrame([(*r, "b", 1) for r in rows], ROWS)


def _table(spark, order=("t",), buckets=4, keys=("K", "n")):
    return KeyedTable.create(spark, shared_path(spark, "t_keyed"), _df(spark, []).schema, keys,
                             order, buckets)


def _state(table, version=None):
    return {(r.k, r.n): (r.t, r.v) for r in table.read(version).collect()}


@pytest.mark.parametrize("order", [("t",), ()])
def test_updates_in_any_order_equal_a_plain_replay(spark, order):
    rng = random.Random(4)
    table, want = _table(spark, order), {}
    for batch in range(5):
        rows = [(f"k{rng.randrange(30)}", rng.randrange(2), rng.randrange(50), f"v{batch}-{i}")
                for i in range(60)]
        rows += rows[:5]
        version = table.upsert(_df(spark, rows), "w", batch)
        best = {}
        for k, n, t, v in rows:  # the winner of a batch, then that of all batches
            best[k, n] = max(best.get((k, n), (-1, "")), (t, v))
        for key, new in best.items():
            old = want.get(key)
            if old is None or not order or new[0] >= old[0]:
                want[key] = new
        assert _state(table) == want
        if batch == 2:
            before = dict(want)
            assert table.compact() == version + 1 and _state(table) == want
    assert _state(table, version=5) == before  # the state of the compaction, still readable
    table.compact()
    assert _state(table) == want and not table.versions.latest()[1]["deltas"]
    key = next(iter(want))
    assert [(r.t, r.v) for r in table.get(*key).collect()] == [want[key]]
    assert table.get("no such", 1).collect() == []


def test_compaction_rewrites_touched_buckets_only(spark):
    table = _table(spark, buckets=16)
    table.upsert(_df(spark, [(f"k{i}", 0, 1, "a") for i in range(200)]))
    table.compact()
    old = table.versions.latest()[1]["base"]
    table.upsert(_df(spark, [("k7", 0, 2, "b")]))
    table.compact()
    new = table.versions.latest()[1]["base"]
    assert sum(old[b] != new[b] for b in old) == 1 and _state(table)["k7", 0] == (2, "b")
    table.upsert(_df(spark, [(f"k{i}", 0, 3, "c") for i in range(200)]))
    table.compact(buckets=[0, 1])  # the other buckets keep their part of the batch
    doc = table.versions.latest()[1]
    assert not {"0", "1"} & set(doc["deltas"][0]["buckets"]) and len(doc["deltas"]) == 1
    assert set(_state(table).values()) == {(3, "c")}


def test_compaction_and_writers_at_once(spark, monkeypatch):
    table = _table(spark)
    for i in range(3):
        table.upsert(_df(spark, [(f"k{j}", 0, i, f"v{i}") for j in range(i, 20)]))
    seen, files = _state(table), table.read()
    write = KeyedTable._write

    def slow(self, df, kind):  # an update comes in while the compaction writes
        out = write(self, df, kind)
        monkeypatch.setattr(KeyedTable, "_write", write)
        table.upsert(_df(spark, [("k1", 0, 9, "meanwhile")]))
        return out

    monkeypatch.setattr(KeyedTable, "_write", slow)
    table.compact()
    assert _state(table) == {**seen, ("k1", 0): (9, "meanwhile")}
    assert {(r.k, r.n): (r.t, r.v) for r in files.collect()} == seen  # a reader's old version

    def dies(self, df, kind):
        write(self, df, kind)
        raise RuntimeError("killed")

    version, doc = table.versions.latest()
    monkeypatch.setattr(KeyedTable, "_write", dies)
    with pytest.raises(RuntimeError, match="killed"):
        table.compact()
    assert table.versions.latest() == (version, doc)

    def other(self, df, kind):  # two compactions: the second to finish gives way
        out = write(self, df, kind)
        monkeypatch.setattr(KeyedTable, "_write", write)
        table.compact()
        return out

    monkeypatch.setattr(KeyedTable, "_write", other)
    with pytest.raises(Conflict):
        table.compact()
    assert _state(table) == {**seen, ("k1", 0): (9, "meanwhile")}


def test_replayed_batch_counts_once_and_null_keys_fail(spark):
    table = _table(spark, order=())
    first = table.upsert(_df(spark, [("a", 1, 1, "x")]), "w", 7)
    assert table.upsert(_df(spark, [("a", 1, 1, "again")]), "w", 7) == first
    assert table.upsert(_df(spark, [("a", 1, 1, "again")]), "w", 3) == first
    assert table.upsert(_df(spark, [("a", 1, 1, "other")]), "w2", 7) == first + 1
    with pytest.raises(ValueError, match="NULL key"):
        table.upsert(_df(spark, [(None, 1, 1, "x"), ("b", 1, 1, "y")]))
    assert _state(table) == {("a", 1): (1, "other")}
    assert table.upsert(_df(spark, []), "w", 8) == first + 2 and _state(table)
    with pytest.raises(ValueError, match="no column"):
        table.upsert(_df(spark, []).drop("v"))
    assert _table(spark).read().collect() == []


def test_only_unnamed_files_are_taken_away(spark):
    table = _table(spark)
    for i in range(3):
        table.upsert(_df(spark, [(f"k{j}", 0, i, "v") for j in range(9)]))
    table.compact()
    want = _state(table)
    assert table.vacuum(keep_versions=1) == []  # too young
    assert len(table.vacuum(keep_versions=1, older_than_s=-60)) == 3
    assert _state(table) == want


def test_stream_updates_the_table_and_restarts(spark):
    topic, ckpt = shared_path(spark, "t_topic"), shared_path(spark, "t_ckpt")
    table = _table(spark)
    aside = shared_path(spark, "t_aside")
    wire = lambda rows: _df(spark, rows).select(
        F.to_json(F.struct("*")).cast("binary").alias("value"))
    junk = spark.createDataFrame([(b"{no",), (b'{"n": 1}',)], "value binary")
    src = lambda: record_source(spark, topic, junk.schema)
    go = lambda: run_upsert(src(), table, ckpt, schema=table.schema, trigger="availableNow",
                            quarantine=aside).awaitTermination()
    wire([("a", 1, 5, "new"), ("b", 1, 1, "b")]).write.mode("append").parquet(topic)
    go()
    wire([("a", 1, 2, "late"), ("c", 1, 1, "c")]).union(junk).write.mode("append").parquet(topic)
    go()
    go()
    assert _state(table) == {("a", 1): (5, "new"), ("b", 1): (1, "b"), ("c", 1): (1, "c")}
    assert read_sink(spark, aside, route="quarantine").count() == 2


def test_versions_are_taken_once(spark):
    v = Versions(spark, shared_path(spark, "t_versions"))
    assert v.latest() == (0, {}) and v.numbers() == []
    v.commit(1, {"a": "ü"})
    with pytest.raises(Taken):
        v.commit(1, {"a": 2})
    calls = []

    def step(doc):
        if not calls:
            v.commit(2, {"a": "won"})  # another writer was faster
        calls.append(doc)
        return {**doc, "b": 1}

    assert v.change(step) == (3, {"a": "won", "b": 1}) and len(calls) == 2
    assert v.change(lambda doc: None) == (3, {"a": "won", "b": 1})
    assert v.read(1) == {"a": "ü"} and v.numbers() == [1, 2, 3]
