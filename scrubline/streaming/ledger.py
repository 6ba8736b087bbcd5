"""A ledger of micro-batches: what each took from its sources, from which offsets to
which, how many rows, and when -- from the progress that Spark reports anyway, so it
costs no job.

An entry is one small JSON file per query and batch; a batch that is replayed after
a restart replaces its entry, as it replaces its rows in the sink
(:func:`scrubline.streaming.write_batch`). Entries are written by the driver, and the
table of them is read like any other.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

SCHEMA = ("query_id string, name string, run_id string, batch_id long, started_at timestamp, "
          "rows long, duration_ms long, sources array<struct<description:string, rows:long, "
          "start_offset:string, end_offset:string>>, observed string")


class BatchLedger(StreamingQueryListener):
    """``spark.streams.addListener(BatchLedger(spark, path))`` keeps the ledger of all
    queries of the session, or of those named in ``queries``."""

    def __init__(self, spark: SparkSession, path: str, queries: tuple[str, ...] = ()):
        super().__init__()
        self.path, self.queries = path.rstrip("/"), queries
        self._sc = spark.sparkContext

    def flush(self) -> None:
        """Wait until what Spark has reported so far is in the ledger."""
        self._sc._jsc.sc().listenerBus().waitUntilEmpty()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.queries and p.name not in self.queries:
            return
        if not p.numInputRows and "addBatch" not in p.durationMs:
            return  # a look for data that found none
        self._write(str(p.id), p.batchId, {
            "query_id": str(p.id), "name": p.name, "run_id": str(p.runId), "batch_id": p.batchId,
            "started_at": p.timestamp, "rows": p.numInputRows,
            "duration_ms": p.durationMs.get("triggerExecution"),
            "sources": [{"description": s.description, "rows": s.numInputRows,
                         "start_offset": s.startOffset, "end_offset": s.endOffset}
                        for s in p.sources],
            "observed": json.dumps({k: v.asDict() for k, v in p.observedMetrics.items()},
                                   default=str)})

    def _write(self, query: str, batch: int, entry: dict) -> None:
        jvm = self._sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{query}-{batch:012d}.json")
        fs = path.getFileSystem(self._sc._jsc.hadoopConfiguration())
        out = fs.create(path, True)  # a replayed batch replaces its entry
        try:
            out.write(bytearray((json.dumps(entry) + "\n").encode()))
        finally:
            out.close()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch; empty if there has been none."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def ledger_against_sink(ledger: DataFrame, sink_rows: DataFrame) -> DataFrame:
    """(query_id, batch_id, taken, written): batches whose count in the sink (a table
    with query_id and batch_id) is not the count that the ledger has."""
    written = sink_rows.groupBy("query_id", "batch_id").agg(F.count(F.lit(1)).alias("written"))
    return (ledger.select("query_id", "batch_id", F.col("rows").alias("taken"))
            .join(written, ["query_id", "batch_id"], "full")
            .filter(~F.coalesce("taken", F.lit(0)).eqNullSafe(F.coalesce("written", F.lit(0)))))
