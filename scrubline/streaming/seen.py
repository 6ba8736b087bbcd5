"""Lossless keyed duplicate removal in a stream.

Spark's own in-stream removal drops rows behind the watermark, because its state
must end. Here the keys seen so far are kept in files, and an index of Bloom filters
says which rows of a micro-batch can be repeats at all:

* every key belongs to one segment of the index, a bitmap of ``BITS`` bits with
  ``PROBES`` bits per key, built and merged by Spark's bitmap aggregates;
* rows whose bits are not all set are new: no look at the keys;
* the few others are compared with the keys themselves (an exact anti-join with the
  buckets they fall into), so nothing is lost and nothing let through twice,
  however many batches lie between two copies and however late a row comes.

A batch adds a run of keys and a run of bitmaps; ``FANOUT`` runs of one level are
merged into one of the next, so a key is rewritten about log(batches) times. When
the segments fill up, the index is built anew with more of them from the keys.
What is seen is versioned (:class:`scrubline.sources.versions.Versions`): a batch that
fails half-way changes nothing, and a batch that is replayed after its version was
made is left out, its rows being in the sink.

The keys are the state, and they grow with the number of distinct keys (about
8 bytes and the key itself each, and 1 to 2.5 bytes of index). NULL is a key like any other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import col, fresh, resolve
from ..operators.cleaning import dedupe, stage_parquet
from ..sources.versions import Versions

#: Bits of a segment: what one bitmap of Spark's bitmap functions holds.
BITS = 32_768
PROBES = 4
#: Keys per segment at which the index is built anew with more segments: about 1 row
#: in 60 is then looked up in vain.
FULL = 3_000
FANOUT = 8
KEY_BUCKETS = 32


class SeenKeys:
    """The keys of a stream, under the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys: str | Sequence[str],
                 segments: int = 16):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.versions = Versions(spark, self.root)
        self.start = {"segments": segments, "n": 0, "runs": [], "applied": {}}
        # Of the files under ``root``; rows may have columns of these names too.
        self._segment, self._map, self._bucket = fresh(
            self.keys, "segment", "bitmap", "bucket")

    def state(self) -> dict:
        return self.versions.latest()[1] or self.start

    # --- the index -------------------------------------------------------------

    def _hash(self, seed: int) -> Column:
        # Nulls leave a hash as it was, so where they stand is hashed as well.
        nulls = F.concat(*[F.when(col(k).isNull(), "1").otherwise("0") for k in self.keys])
        return F.xxhash64(F.lit(seed), nulls, *[col(k) for k in self.keys])

    def _segment_of(self, segments: int) -> Column:
        return F.pmod(self._hash(-1), F.lit(segments)).cast("int")

    def _probes(self) -> Column:
        return F.array(*[F.pmod(self._hash(i), F.lit(BITS)) for i in range(PROBES)])

    def _bitmaps(self, keys: DataFrame, segments: int) -> DataFrame:
        probes = keys.select(self._segment_of(segments).alias(self._segment),
                             F.explode(self._probes()).alias("p"))
        return probes.groupBy(self._segment).agg(
            F.bitmap_construct_agg(F.col("p")).alias(self._map))

    def _index(self, runs: list[dict]) -> DataFrame | None:
        """One bitmap per segment."""
        if not runs:
            return None
        out = self.spark.read.parquet(*[f"{self.root}/{r['index']}" for r in runs])
        return out.groupBy(self._segment).agg(F.bitmap_or_agg(self._map).alias(self._map))

    def _marked(self, rows: DataFrame, doc: dict, out: str) -> DataFrame:
        """``rows`` with a column ``out`` that says whether their key may be known."""
        index = self._index(doc["runs"])
        if index is None:
            return rows.withColumn(out, F.lit(False))
        mine, theirs, bits = fresh([*rows.columns, out], "mine", "theirs", "bits")
        joined = rows.withColumn(mine, self._segment_of(doc["segments"])).join(
            index.select(col(self._segment).alias(theirs), col(self._map).alias(bits)),
            col(mine) == col(theirs), "left")
        byte = lambda p: F.conv(F.hex(F.substring(
            col(bits), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.forall(self._probes(), lambda p: F.floor(byte(p) / F.pow(F.lit(2), p % 8)) % 2 == 1)
        return joined.withColumn(out, F.coalesce(hit, F.lit(False))).select(
            *[col(c) for c in rows.columns], col(out))

    # --- the keys --------------------------------------------------------------

    def _bucket_of(self) -> Column:
        return F.pmod(self._hash(-2), F.lit(KEY_BUCKETS)).cast("int")

    def _known(self, doc: dict) -> DataFrame:
        """All keys seen, by bucket."""
        out = None
        for r in doc["runs"]:
            one = self.spark.read.parquet(f"{self.root}/{r['keys']}")
            out = one if out is None else out.unionByName(one)
        return out

    def unseen(self, batch: DataFrame, order: str | Sequence[str] | None = None,
               doc: dict | None = None) -> DataFrame:
        """The rows of ``batch`` whose key has not been seen, one per key (the first
        in ``order``, or the smallest row)."""
        doc = doc or self.state()
        keys = resolve(batch, self.keys)
        rest = [c for c in batch.columns if c not in keys]
        flag, at, *known_keys = fresh(batch, "maybe", "at", *[f"key{i}" for i in range(len(keys))])
        one = dedupe(batch, keys, order or rest) if rest else batch.distinct()
        marked = stage_parquet(self._marked(one, doc, flag), "seen_marked")
        new = marked.filter(~col(flag)).drop(flag)
        maybe = marked.filter(col(flag)).drop(flag)
        if not doc["runs"] or maybe.isEmpty():
            return new
        known = self._known(doc).select(
            col(self._bucket).alias(at), *[col(k).alias(n) for k, n in zip(self.keys, known_keys)])
        same = self._bucket_of() == col(at)
        for k, n in zip(keys, known_keys):
            same = same & col(k).eqNullSafe(col(n))
        return new.unionByName(maybe.join(known, same, "left_anti"))

    # --- runs ------------------------------------------------------------------

    def _run(self, keys: DataFrame, segments: int, level: int) -> dict:
        name = uuid.uuid4().hex
        run = {"keys": f"keys/{name}", "index": f"index/{name}", "level": level}
        keys.withColumn(self._bucket, self._bucket_of()).repartition(col(self._bucket)).write.partitionBy(
            self._bucket).parquet(f"{self.root}/{run['keys']}")
        made = self.spark.read.schema(keys.schema).parquet(f"{self.root}/{run['keys']}")
        run["n"] = made.count()
        self._bitmaps(made, segments).coalesce(1).write.parquet(f"{self.root}/{run['index']}")
        return run

    def add(self, rows: DataFrame, writer: str, batch: int) -> dict:
        """Count the keys of ``rows`` (unseen ones) as seen."""
        def step(now):
            now = dict(now or self.start)
            if now["applied"].get(writer, -1) >= batch:
                return None
            run = self._run(rows.select(*[col(k) for k in self.keys]), now["segments"], 0)
            runs = [*now["runs"], *([run] if run["n"] else [])]
            n = now["n"] + run["n"]
            segments = now["segments"]
            if n > FULL * segments:
                while n > FULL * segments // 2:
                    segments *= 2
                all_keys = self._known({"runs": runs}).drop(self._bucket)
                runs = [self._run(all_keys, segments, max(r["level"] for r in runs))]
            while True:
                level = next((x for x in {r["level"] for r in runs}
                              if sum(r["level"] == x for r in runs) >= FANOUT), None)
                if level is None:
                    break
                old = [r for r in runs if r["level"] == level]
                merged = self._run(self._known({"runs": old}).drop(self._bucket), segments,
                                   level + 1)
                runs = [r for r in runs if r["level"] != level] + [merged]
            return {"segments": segments, "n": n, "runs": runs,
                    "applied": {**now["applied"], writer: batch}}

        return self.versions.change(step)[1]


def dedupe_lossless(source: DataFrame, keys: str | Sequence[str], seen: str, checkpoint: str,
                    sink: Callable[[DataFrame, int], object], *,
                    order: str | Sequence[str] | None = None, trigger: str | None = None,
                    query_name: str | None = None) -> StreamingQuery:
    """Stream ``source``, handing ``sink(rows, batch id)`` the rows whose key comes for
    the first time. ``seen`` is the folder of the keys; ``sink`` must write a batch
    that is handed to it twice as one (:func:`scrubline.streaming.write_batch` does).
    ``trigger`` as in :func:`scrubline.streaming.run_ingest`."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        known = SeenKeys(spark, seen, keys)
        if known.state()["applied"].get(writer, -1) >= batch_id:
            return
        rows = stage_parquet(known.unseen(batch, order), "seen_new")
        sink(rows, batch_id)
        known.add(rows, writer, batch_id)

    w = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
