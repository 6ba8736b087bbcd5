"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder (``spark.checkpoint.dir``) and read
    it back: later steps read files every executor sees, so a lost executor
    costs a re-read and not the lineage above."""
    path = shared_path(df.sparkSession, "llm", label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """The file system and the path of a URI, as pyarrow names them: for files under
    the shared folder that tasks read or write themselves."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", re.sub(r"^s3[an]:", "s3:", uri))
    return fs.FileSystem.from_uri(uri)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    A lambda variable is bound once per row, whereas a plain column expression
    that a higher-order function refers to is re-evaluated per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


class IdFilter:
    """A bitmap of the ids (longs) of a table, to pass rows over where they are read:
    :meth:`maybe` is true for every id of the table and for few others. It has
    ``BITS_PER_ID`` bits per id, and never more than ``MOST_BITS`` (32 MB), which is
    all that the driver and the tasks hold; beyond that it passes over fewer rows.
    What it lets through still has to be joined."""

    BITS_PER_ID = 16
    MOST_BITS = 1 << 28
    PROBES = 3

    def __init__(self, ids: DataFrame):
        ids = stage(ids, "id_filter")
        bits = 1 << 13
        while bits < min(self.MOST_BITS, self.BITS_PER_ID * ids.count()):
            bits *= 2
        words = (ids.mapInArrow(self._words(bits), "word long, bits long")
                 .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
        held = np.zeros(bits // 64, np.int64)
        held[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.bits, self.held = bits, ids.sparkSession.sparkContext.broadcast(held)

    @classmethod
    def _places(cls, ids: np.ndarray, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            step = (h >> np.uint64(32)) | np.uint64(1)
            k = np.arange(cls.PROBES, dtype=np.uint64)[:, None]
            return ((h + k * step) & np.uint64(bits - 1)).astype(np.int64)

    @classmethod
    def _words(cls, bits: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(cls._places(batch.column(0).drop_null().to_numpy(), bits))
                word, of = np.unique(at >> 6, return_inverse=True)
                out = np.zeros(len(word), np.int64)
                np.bitwise_or.at(out, of, np.int64(1) << (at & 63))
                yield pa.RecordBatch.from_pydict({"word": pa.array(word, pa.int64()),
                                                  "bits": pa.array(out, pa.int64())})
        return run

    def maybe(self, ids: pa.Array) -> pa.Array:
        """Per id whether it may be in the table (a null never is). In tasks."""
        at = self._places(ids.fill_null(0).to_numpy(zero_copy_only=False), self.bits)
        hit = ((self.held.value[at >> 6] >> (at & 63)) & 1).all(0)
        return pa.array(hit & ids.is_valid().to_numpy(zero_copy_only=False))

    def __getstate__(self):
        return {"bits": self.bits, "held": self.held}


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * n, pa.int32()),
             pa.array(range(before + 1, before + n + 1), pa.int64())],
            names=[*batch.schema.names, "slice_", "local_"])
        before += n


def global_rank(df: DataFrame, order: list[str], out: str, label: str) -> DataFrame:
    """``df`` with ``out``: 1, 2, 3... over all rows in ascending ``order``. Rows are
    cut into key ranges and numbered inside them; what the ranges before hold (one
    row per range) is added. No window over all rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*df.schema.fields, T.StructField("slice_", T.IntegerType()),
                           T.StructField("local_", T.LongType())])
    cut = stage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .mapInArrow(_numbered, schema), label)
    before = Window.orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    start = (cut.groupBy("slice_").agg(F.max("local_").alias("n_"))
             .select("slice_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_")))
    return cut.join(F.broadcast(start), "slice_").withColumn(
        out, F.col("start_") + F.col("local_")).drop("slice_", "local_", "start_")
