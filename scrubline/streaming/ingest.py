"""Micro-batch ingestion: decode -> route -> idempotent keyed sink.

Sink contract (each point is a test):
* each micro-batch is written to ``<sink>/query_id=Q/batch_id=N`` with overwrite,
  so a batch replayed after a failure replaces itself instead of adding copies,
  and a second query (or the same one with a new checkpoint, whose batches start
  at 0 again) cannot erase what an earlier one wrote;
* sink errors propagate, so the batch is not committed and is replayed on
  restart (swallowing them would lose it);
* the batch is evaluated once (one write, with the row count taken by ``observe``
  during that same write); a batch that turns out to be empty leaves nothing behind;
* a ledger of the batches can be kept (:class:`scrubline.streaming.ledger.BatchLedger`);
* readers take the latest row per key across batches (``latest_by_key``).
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import parse_timestamp
from ..functions.names import fresh, resolve
from ..functions.json import CORRUPT_COL, ROUTE_COL, VALID, decode_json, split_valid
from ..operators.cleaning import dedupe
from ..schemas import WEATHER_FLAT, WEATHER_TIME_FORMAT
from ..sources.keyed_table import KeyedTable

log = logging.getLogger(__name__)

BATCH_COL = "batch_id"
QUERY_COL = "query_id"
#: When the batch was written: orders the batches of different queries.
WRITTEN_COL = "written_at"


def write_batch(batch_df: DataFrame, batch_id: int, sink: str, *, fmt: str = "parquet",
                route_col: str | None = None, preview: int = 0,
                options: dict[str, str] | None = None) -> int:
    """Write one micro-batch; returns its row count (0: nothing is left behind).

    ``route_col`` partitions the batch folder by route (valid/quarantine) in
    the same single write. ``preview`` logs the first rows (off by default:
    it is an extra job). The query id is the one that Spark keeps in the
    checkpoint; a call outside a stream belongs to the query ``direct``."""
    if preview:
        log.info("batch %s preview:\n%s", batch_id, batch_df.limit(preview).toPandas())
    obs = Observation(f"batch_{batch_id}")
    query = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    stamped = batch_df.withColumn(WRITTEN_COL, F.current_timestamp())
    observed = stamped.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").format(fmt).options(**(options or {}))
    if route_col:
        writer = writer.partitionBy(route_col)
    folder = f"{sink.rstrip('/')}/{QUERY_COL}={query or 'direct'}/{BATCH_COL}={int(batch_id)}"
    writer.save(folder)
    n = int(obs.get["rows"])
    if not n:  # known from the one job that wrote it
        _drop_empty(batch_df.sparkSession, folder)
        log.info("batch %s is empty; nothing written", batch_id)
        return 0
    log.info("batch %s: %d rows written", batch_id, n)
    return n


def _drop_empty(spark: SparkSession, folder: str) -> None:
    """Delete the folder of a batch without rows, and the folders above it (query,
    sink) if nothing else is in them."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.delete(path, True)
    for _ in range(2):
        path = path.getParent()
        if not fs.exists(path) or len(fs.listStatus(path)):
            break
        fs.delete(path, False)


def to_sink_types(df: DataFrame, time_cols: Sequence[str] = ("localtime", "last_updated"),
                  fmt: str = WEATHER_TIME_FORMAT) -> DataFrame:
    """Observation strings -> sink types: local times parsed to TIMESTAMP_NTZ."""
    return df.withColumns({c: parse_timestamp(c, fmt) for c in time_cols if c in df.columns})


def decode_stream(df: DataFrame, schema: T.StructType = WEATHER_FLAT, *,
                  required: Sequence[str] = ("id",), value_col: str = "value",
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Wire records -> typed rows tagged valid/quarantine (stateless; works on
    batch and streaming DataFrames alike). Quarantined rows keep the raw
    payload in ``_corrupt_record`` or, when it parsed, their fields."""
    decoded = split_valid(decode_json(df, schema, value_col=value_col), required)
    if transform is not None:
        decoded = transform(decoded)
    return decoded


def run_ingest(source: DataFrame, sink: str, checkpoint: str, *,
               schema: T.StructType = WEATHER_FLAT, required: Sequence[str] = ("id",),
               decode: bool = True, transform: Callable[[DataFrame], DataFrame] | None = None,
               trigger: str | None = None, fmt: str = "parquet",
               query_name: str | None = None, preview: int = 0,
               options: dict[str, str] | None = None) -> StreamingQuery:
    """Start ``source -> decode -> route -> write_batch`` with a checkpoint.

    ``trigger``: ``None`` (back-to-back micro-batches until stopped),
    ``"availableNow"`` (drain what is there, then stop) or a processing-time
    interval such as ``"10 seconds"``. ``checkpoint`` is required and must be
    a shared path on a cluster."""
    if not checkpoint:
        raise ValueError("run_ingest needs a checkpoint location")
    if decode:
        df = decode_stream(source, schema, required=required, transform=transform)
    else:
        df = transform(source) if transform is not None else source
    route = ROUTE_COL if ROUTE_COL in df.columns else None
    writer = (df.writeStream
              .foreachBatch(functools.partial(_batch_writer, sink=sink, fmt=fmt, route_col=route,
                                              preview=preview, options=options))
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def _batch_writer(batch_df: DataFrame, batch_id: int, *, sink: str, fmt: str,
                  route_col: str | None, preview: int = 0,
                  options: dict[str, str] | None = None) -> None:
    write_batch(batch_df, batch_id, sink, fmt=fmt, route_col=route_col, preview=preview,
                options=options)


def run_upsert(source: DataFrame, table: KeyedTable, checkpoint: str, *,
               schema: T.StructType = WEATHER_FLAT, decode: bool = True,
               transform: Callable[[DataFrame], DataFrame] | None = None,
               quarantine: str | None = None, trigger: str | None = None,
               query_name: str | None = None) -> StreamingQuery:
    """Start ``source -> decode -> keyed table``: every micro-batch updates the rows
    of its keys. A batch counts once, however often it is replayed (the table notes
    the last batch of each query). Rows that do not decode, or lack a key, go to the
    folder ``quarantine`` (:func:`write_batch`), and without one they fail the batch."""
    if not checkpoint:
        raise ValueError("run_upsert needs a checkpoint location")
    if decode:
        df = decode_stream(source, schema, required=table.keys, transform=transform)
    else:
        df = transform(source) if transform is not None else source

    def each(batch_df: DataFrame, batch_id: int) -> None:
        writer = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = batch_df
        if ROUTE_COL in rows.columns:
            bad = rows.filter(F.col(ROUTE_COL) != VALID)
            if quarantine is not None:
                write_batch(bad, batch_id, quarantine)
                rows = rows.filter(F.col(ROUTE_COL) == VALID)
            elif not bad.isEmpty():
                raise ValueError(f"batch {batch_id} has rows that are not valid")
        table.upsert(rows, writer=writer or "direct", batch=batch_id)

    w = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def read_sink(spark: SparkSession, sink: str, schema: T.StructType | None = None,
              route: str | None = VALID, fmt: str = "parquet") -> DataFrame:
    """All batches of a sink (``batch_id`` and ``written_at`` columns included);
    ``route`` selects the valid or quarantine rows when the sink is routed
    (partition pruning)."""
    reader = spark.read.format(fmt)
    if not _holds_files(spark, sink):  # no batch with rows yet
        if schema is None:
            raise ValueError(f"{sink} holds no rows yet: give a schema to read it as empty")
        batch = [] if BATCH_COL in schema.names else [T.StructField(BATCH_COL, T.LongType())]
        written = ([] if WRITTEN_COL in schema.names
                   else [T.StructField(WRITTEN_COL, T.TimestampType())])
        return spark.createDataFrame([], T.StructType(schema.fields + written + batch))
    if schema is not None:
        known = {f.name for f in schema.fields}
        extra = [T.StructField(WRITTEN_COL, T.TimestampType()),
                 T.StructField(QUERY_COL, T.StringType()),
                 T.StructField(BATCH_COL, T.LongType())]
        reader = reader.schema(T.StructType(
            schema.fields + [f for f in extra if f.name not in known]))
    df = reader.load(sink).drop(QUERY_COL)
    if route is not None and ROUTE_COL in df.columns:
        df = df.filter(F.col(ROUTE_COL) == route).drop(ROUTE_COL)
        if route == VALID:
            df = df.drop(CORRUPT_COL)  # always NULL on valid rows
    return df


def _holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a batch has been written under ``path`` (two levels of folders)."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    glob = sc._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{QUERY_COL}=*/{BATCH_COL}=*")
    return bool(fs.exists(root) and fs.globStatus(glob))


def latest_by_key(df: DataFrame, key: str | Sequence[str],
                  order: str | Sequence[str] | None = None) -> DataFrame:
    """Latest row per key (keep-latest upsert semantics on read). ``order``
    lists the recency columns, ``-`` for descending; the survivor is the first
    row in that order (by default the batch written last, then the highest
    batch number). Computed as an aggregate, so a hot key is collapsed map-side."""
    if order is None:
        order = [f"-{c}" for c in (WRITTEN_COL, BATCH_COL) if c in df.columns]
    return dedupe(df, key, list(order) if not isinstance(order, str) else [order])


def dedupe_stream(df: DataFrame, key: str | Sequence[str], event_time: str,
                  delay: str) -> DataFrame:
    """In-stream keyed dedup: ``dropDuplicatesWithinWatermark``. There is no
    default ``delay``: a row that comes in a later batch behind the watermark is
    dropped, so the caller has to state how late rows can be (the lossless ways
    are :func:`scrubline.streaming.dedupe_lossless` and ``latest_by_key`` on read). Needs a
    TIMESTAMP event time; a zone-less (NTZ) column is cast for the watermark
    only (helper column, dropped after), so the output keeps its type. State
    is bounded by the watermark delay."""
    keys = [key] if isinstance(key, str) else list(key)
    event_time, = resolve(df, event_time)
    dtype = df.schema[event_time].dataType
    wm = event_time
    if isinstance(dtype, T.TimestampNTZType):
        wm, = fresh(df, "event_time")
        df = df.withColumn(wm, F.col(event_time).cast("timestamp"))
    out = df.withWatermark(wm, delay).dropDuplicatesWithinWatermark(resolve(df, keys))
    return out.drop(wm) if wm != event_time else out


def stream_sink(df: DataFrame, checkpoint: str, *, kind: str = "files", path: str | None = None,
                servers: str | None = None, topic: str | None = None, fmt: str = "parquet",
                trigger: str | None = None) -> StreamingQuery:
    """Write encoded records (``value`` bytes) to a Kafka topic or to files."""
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if kind == "kafka":
        w = w.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    elif kind == "files":
        w = w.format(fmt).option("path", path)
    else:
        raise ValueError(f"unknown sink kind {kind!r}")
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
