"""A keyed table that later writes update: a base in key buckets, batches of
updates beside it, and a version that says which files count.

* ``upsert`` writes one batch, a row per key, in files by bucket, and adds it to
  the version: no row of the base is read or rewritten.
* ``read`` merges: buckets without updates are read as they are; in the others the
  newest update of a key takes the place of its row. Only those rows are joined,
  and Spark broadcasts the updates where their measured size allows.
* ``compact`` rewrites the buckets that have updates (or those asked for), and no
  other. A reader that began before keeps its version; a compaction that dies
  changes nothing; updates that come in meanwhile stay beside the new base.
* A batch of a named writer counts once: replaying it changes nothing.

The winner of a key is the row that is greatest in the ``order`` columns, and among
equals the one written last; without ``order`` the one written last. So updates may
come out of order. Keys must not be NULL. Files are only ever added; ``vacuum``
takes away those that no kept version names.

One bucket is written by one task, so choose ``buckets`` for a bucket of about a
gigabyte. A key is one row per batch, so a hot key is one row too: it is collapsed in
the map tasks before the shuffle.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, fresh, resolve
from .versions import Versions


class Conflict(Exception):
    """Another compaction has rewritten the same buckets."""


class KeyedTable:
    """``KeyedTable.create(spark, root, schema, keys)`` makes one,
    ``KeyedTable(spark, root)`` opens it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = Versions(spark, self.root)
        number, doc = self.versions.latest()
        if not number:
            raise ValueError(f"{root} holds no keyed table")
        self.schema = T.StructType.fromJson(doc["schema"])
        self.keys, self.order, self.buckets = doc["keys"], doc["order"], doc["buckets"]
        self._bucket, self._seq, self._old, self._new = fresh(
            self.schema.names, "bucket", "seq", "old", "new")

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: T.StructType,
               keys: str | Sequence[str], order: str | Sequence[str] = (),
               buckets: int = 64) -> KeyedTable:
        empty = spark.createDataFrame([], schema)
        keys, order = resolve(empty, keys), resolve(empty, order)
        if not keys or set(keys) & set(order):
            raise ValueError("a keyed table needs keys, and an order of other columns")
        Versions(spark, root).commit(1, {
            "schema": json.loads(schema.json()), "keys": keys, "order": order,
            "buckets": buckets, "base": {}, "deltas": [], "applied": {}})
        return cls(spark, root)

    # --- writing ---------------------------------------------------------------

    def _bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, kind: str) -> dict[str, str]:
        """Files by bucket in a new folder; returns bucket -> its folder."""
        name = f"data/{kind}-{uuid.uuid4().hex}"
        (df.withColumn(self._bucket, self._bucket_of()).repartition(col(self._bucket))
         .write.mode("errorifexists").partitionBy(self._bucket).parquet(f"{self.root}/{name}"))
        fs = self.versions._context.util()
        path = self.versions._hadoop.Path(f"{self.root}/{name}")
        found = [s.getPath().getName() for s in fs.listStatus(path)]
        return {f.split("=", 1)[1]: f"{name}/{f}" for f in found if "=" in f}

    def upsert(self, df: DataFrame, writer: str = "direct", batch: int | None = None) -> int:
        """Add the rows of ``df`` (columns by name); returns the version that has
        them. Of several rows of a key the winner is kept (should they be equal in
        the order, the greatest in the rest)."""
        def applied(doc):
            return batch is not None and doc["applied"].get(writer, -1) >= batch

        number, doc = self.versions.latest()
        if applied(doc):
            return number
        rows = df.select(*[col(c).cast(f.dataType).alias(f.name)
                           for c, f in zip(resolve(df, self.schema.names), self.schema.fields)])
        bad = Observation(f"keys_{uuid.uuid4().hex[:8]}")
        missing = F.lit(False)
        for k in self.keys:
            missing = missing | col(k).isNull()
        rows = rows.observe(bad, F.count_if(missing).alias("missing"))
        rest = [c for c in self.schema.names if c not in self.keys]
        if rest:
            # The order columns first: the greatest row of a batch is its winner.
            ranked = [*self.order, *[c for c in rest if c not in self.order]]
            best = F.max(F.struct(*[col(c) for c in ranked])).alias(self._new)
            one = rows.groupBy(*[col(k) for k in self.keys]).agg(best)
            rows = one.select(*[col(c) if c in self.keys else col(self._new)[c].alias(c)
                                for c in self.schema.names])
        else:
            rows = rows.distinct()
        where = self._write(rows, "delta")
        if bad.get["missing"]:
            raise ValueError(f"{bad.get['missing']} rows have a NULL key; nothing was written")

        def add(now):
            if applied(now):
                return None
            now = dict(now)
            if where:
                now["deltas"] = [*now["deltas"], {"id": uuid.uuid4().hex, "buckets": where}]
            if batch is not None:
                now["applied"] = {**now["applied"], writer: batch}
            return now

        return self.versions.change(add)[0]

    # --- reading ---------------------------------------------------------------

    def _files(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def _merged(self, doc: dict, buckets: set[str]) -> DataFrame:
        """The rows of the given buckets."""
        touched = {b for d in doc["deltas"] for b in d["buckets"]} & buckets
        parts = [f for b, f in doc["base"].items() if b in buckets - touched]
        out = self._files(parts) if parts else None
        if touched:
            new = None
            for seq, d in enumerate(doc["deltas"]):
                here = [f for b, f in d["buckets"].items() if b in touched]
                if here:
                    one = self._files(here).withColumn(self._seq, F.lit(seq))
                    new = one if new is None else new.unionByName(one)
            rank = F.struct(*[col(c) for c in self.order], col(self._seq))
            row = F.struct(*[col(c) for c in self.schema.names])
            keys = [col(k) for k in self.keys]
            new = new.groupBy(*keys).agg(F.max_by(row, rank).alias(self._new))
            old = [f for b, f in doc["base"].items() if b in touched]
            if old:
                merged = self._replaced(self._files(old), new)
            else:
                merged = new.select(f"{self._new}.*")
            out = merged if out is None else out.unionByName(merged)
        if out is None:
            out = self.spark.createDataFrame([], self.schema)
        return out

    def _replaced(self, old: DataFrame, new: DataFrame) -> DataFrame:
        keys = [col(k) for k in self.keys]
        held = old.select(*keys, F.struct(*[col(c) for c in self.schema.names]).alias(self._old))
        stays = F.lit(False)
        if self.order:  # an update that is older than the row loses
            stays = (F.struct(*[col(self._old)[c] for c in self.order])
                     > F.struct(*[col(self._new)[c] for c in self.order]))
        pick = F.when(col(self._new).isNull() | stays, col(self._old)).otherwise(col(self._new))
        kept = held.join(new, self.keys, "left").select(pick.alias(self._new))
        added = new.join(old.select(*keys), self.keys, "left_anti").select(col(self._new))
        return kept.unionByName(added).select(f"{self._new}.*")

    def _doc(self, version: int | None) -> dict:
        return self.versions.latest()[1] if version is None else self.versions.read(version)

    def read(self, version: int | None = None) -> DataFrame:
        """One row per key, as of a version (by default the newest)."""
        doc = self._doc(version)
        return self._merged(doc, {*doc["base"], *[b for d in doc["deltas"] for b in d["buckets"]]})

    def get(self, *values, version: int | None = None) -> DataFrame:
        """The row of one key; reads the files of its bucket only."""
        if len(values) != len(self.keys):
            raise ValueError(f"the key has {len(self.keys)} columns")
        lits = [F.lit(v).cast(self.schema[k].dataType).alias(k)
                for k, v in zip(self.keys, values)]
        bucket = self.spark.range(1).select(*lits).select(self._bucket_of()).collect()[0][0]
        same = F.lit(True)
        for k, v in zip(self.keys, lits):
            same = same & (col(k) == v)
        return self._merged(self._doc(version), {str(bucket)}).filter(same)

    # --- upkeep ----------------------------------------------------------------

    def compact(self, min_deltas: int = 1, buckets: Sequence[int] | None = None) -> int:
        """Rewrite the buckets that at least ``min_deltas`` batches have touched (of
        ``buckets``, if given); returns the version. Raises :class:`Conflict` if
        another compaction did so first."""
        number, doc = self.versions.latest()
        count: dict[str, int] = {}
        for d in doc["deltas"]:
            for b in d["buckets"]:
                count[b] = count.get(b, 0) + 1
        todo = {b for b, n in count.items() if n >= min_deltas}
        if buckets is not None:
            todo &= {str(b) for b in buckets}
        if not todo:
            return number
        where = self._write(self._merged(doc, todo), "base")
        seen = {d["id"] for d in doc["deltas"]}

        def swap(now):
            if any(now["base"].get(b) != doc["base"].get(b) for b in todo):
                raise Conflict(sorted(todo))
            deltas = []
            for d in now["deltas"]:
                left = {b: f for b, f in d["buckets"].items()
                        if d["id"] not in seen or b not in todo}
                if left:
                    deltas.append({**d, "buckets": left})
            return {**now, "base": {**now["base"], **where}, "deltas": deltas}

        return self.versions.change(swap)[0]

    def vacuum(self, keep_versions: int = 2, older_than_s: float = 86_400.0) -> list[str]:
        """Delete data folders that none of the last ``keep_versions`` versions names
        and that are old enough to belong to no running writer; returns them."""
        named = set()
        for n in self.versions.numbers()[-max(1, keep_versions):]:
            doc = self.versions.read(n)
            for f in [*doc["base"].values(), *[f for d in doc["deltas"]
                                               for f in d["buckets"].values()]]:
                named.add(f.split("/")[1])
        fs, path = self.versions._context, self.versions._hadoop.Path
        gone = []
        if not fs.util().exists(path(f"{self.root}/data")):
            return gone
        for s in fs.util().listStatus(path(f"{self.root}/data")):
            name = s.getPath().getName()
            if name not in named and s.getModificationTime() < (time.time() - older_than_s) * 1000:
                fs.delete(s.getPath(), True)
                gone.append(name)
        return gone
