"""Every operator shown on the driver's tables, with its DuckDB oracle.

The driver tables carry no layoffs or weather data, so each operator runs on
a driver table of the same shape; dirty inputs (padded names, blank codes,
dates as text, JSON payloads) are made by a deterministic expression that is
written in both dialects. Every query reads whole tables.

Staged tables, landing folders, sinks and checkpoints are created under the
shared folder (``spark.checkpoint.dir``), a fresh leaf per call.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import ROUTE_COL, decode_json, encode_json, flatten, split_valid
from ..operators import analysis as A
from ..operators import cleaning as C
from ..plans.cleaning_job import CleanSpec, clean
from ..schemas import LAYOFFS_CLEAN, LAYOFFS_COLUMNS, NTZ_JSON_FORMAT, WEATHER_NESTED
from ..plans.produce import observations, produce
from ..session import shared_path
from ..sources.evolving_table import EvolvingTable, Field
from ..sources.keyed_table import KeyedTable
from ..sources.record_log import Log, append_log, log_source, read_log, stream_log
from ..sources.streams import landing_source, record_source
from ..sources.tables import insert_into, stage_like, stage_table
from ..streaming.ingest import (dedupe_stream, latest_by_key, read_sink, run_ingest, run_upsert,
                                to_sink_types, write_batch)
from ..streaming.ledger import BatchLedger, ledger_against_sink, read_ledger
from ..streaming.seen import dedupe_lossless

QueryFn = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _qty(col: str = "l_quantity"):
    # Sum integers, as the original does, so totals do not depend on the
    # order of floating-point additions.
    return F.col(col).cast("int")


# --------------------------------------------------------------------------
# Scans, staging (O-01..O-05, O-19, O-21)
# --------------------------------------------------------------------------

def stage_copy(spark, d):
    part = _t(spark, d, "part")
    name = _name("part_staging")
    stage_table(spark, name, schema=part.schema)        # CREATE TABLE (declared)
    return insert_into(part, name)                      # INSERT INTO ... SELECT *


def stage_numbered(spark, d):
    numbered = C.number_duplicates(_t(spark, d, "documents"), ["text"], order=["doc_id"],
                                   wide=True)
    first = _name("docs_numbered")
    stage_table(spark, first, schema=numbered.schema)
    second = _name("docs_numbered2")
    stage_like(spark, second, like=first)               # CREATE TABLE ... LIKE
    staged = insert_into(numbered, second)              # INSERT ... SELECT *, ROW_NUMBER()
    return staged.filter(F.col("row_num") == 1).drop("row_num")


# --------------------------------------------------------------------------
# Duplicates (O-09, O-10, O-36)
# --------------------------------------------------------------------------

def dedup_documents(spark, d):
    docs = _t(spark, d, "documents")
    return (C.dedupe(docs, ["text", "lang", "source"], order=["doc_id"], wide=True)
            .select("text", "lang", "source", "n_chars"))


def dedup_text_lang(spark, d):
    return C.dedupe(_t(spark, d, "documents").select("text", "lang"), wide=True)


def dedup_orders(spark, d):
    return C.dedupe(_t(spark, d, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"],
                    order=["o_orderkey"])


def number_duplicates(spark, d):
    return C.number_duplicates(_t(spark, d, "documents"), ["text"], order=["doc_id"], wide=True)


# --------------------------------------------------------------------------
# Row-level DML as transforms (O-11..O-18, F-01..F-05)
# --------------------------------------------------------------------------

def delete_where(spark, d):
    return C.delete_where(_t(spark, d, "lineitem"), F.col("l_returnflag") == "R")


def drop_all_null(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source")
    joined = docs.join(_t(spark, d, "labels"), "doc_id", "left")
    return C.drop_all_null(joined, ["quality", "toxic"])


def trim_names(spark, d):
    cust = _t(spark, d, "customer")
    padded = cust.withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return C.trim(padded, "c_name")


def canonical_brand(spark, d):
    return C.canonicalize_prefix(_t(spark, d, "part"), "p_brand", "Brand#2")


def strip_dots(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return C.strip_trailing(docs, "text", ".", where_prefix="T")


def blank_to_null(spark, d):
    orders = _t(spark, d, "orders")
    blanked = orders.withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")))
    return C.blank_to_null(blanked, "o_orderstatus")


def fill_from_peers(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "source")
    labelled = docs.join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return C.fill_from_peers(labelled, "source", "quality", stage=True)


def parse_date(spark, d):
    orders = _t(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("o_orderdate"))
    return C.parse_date(orders, "o_orderdate")


def text_equals_one(spark, d):
    labels = _t(spark, d, "labels")
    as_text = labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, F.concat(F.col("quality").cast("string"), F.lit(".0")))
         .otherwise(F.col("quality").cast("string")).alias("quality_text"),
        "toxic")
    return A.numeric_text_equals(as_text, "quality_text", 1.0, order_by="doc_id")


# --------------------------------------------------------------------------
# Aggregations, windows (O-30..O-33, O-37, O-38, O-42, O-43)
# --------------------------------------------------------------------------

def total_by_flag(spark, d):
    return A.total_by(_t(spark, d, "lineitem"), "l_returnflag", _qty(), out="total_quantity")


def total_by_year(spark, d):
    # Pre-aggregate lineitem per order before the join: the aggregate's
    # shuffle on l_orderkey is the partitioning the join needs, and it
    # carries one row per order instead of one per line.
    per_order = (_t(spark, d, "lineitem").groupBy("l_orderkey")
                 .agg(F.sum(_qty()).alias("q")))
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
    return A.total_by(joined, F.year("o_orderdate").alias("year"), "q", out="total_quantity")


def _month_totals(spark, d, out="total_quantity"):
    return A.total_by_period(_t(spark, d, "lineitem"), "l_shipdate", _qty(), period="month",
                             out=out, sort="asc")


def total_by_month(spark, d):
    return _month_totals(spark, d)


def running_total(spark, d):
    by_month = _month_totals(spark, d, out="total_off")
    return A.running_total(by_month, "month", "total_off", unique_order=True).orderBy("month")


def _supplier_year(spark, d):
    return A.total_by_period(_t(spark, d, "lineitem"), "l_shipdate", _qty(), period="year",
                             keys=["l_suppkey"], out="total_quantity")


def total_by_supplier_year(spark, d):
    return _supplier_year(spark, d).orderBy(F.col("total_quantity").desc())


def order_date_span(spark, d):
    orders = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("o_orderdate"))
    return A.date_span(orders, "o_orderdate")


def top5_supplier_year(spark, d):
    return A.top_n_per_group(_supplier_year(spark, d), "year", "total_quantity", n=5)


# --------------------------------------------------------------------------
# JSON wire format (O-07, O-27, O-28, O-35, F-10..F-15)
# --------------------------------------------------------------------------

PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])

EVENT_NESTED = T.StructType([
    T.StructField("meta", T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
    ])),
    T.StructField("body", T.StructType([
        T.StructField("event_type", T.StringType()),
        T.StructField("payload", T.StructType([
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ])),
    ])),
])

EVENT_PATHS = {
    "id": "meta.event_id",
    "event_time": "meta.ts",
    "user_key": "meta.user_id",
    "kind": "body.event_type",
    "amount": "body.payload.value",
    "props": "body.payload.props",
}


def _nested_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.struct("event_id", "ts", "user_id").alias("meta"),
        F.struct("event_type", F.struct("value", "props").alias("payload")).alias("body"))


def decode_props(spark, d):
    events = _t(spark, d, "events").select("event_id", F.col("props").alias("value"))
    return decode_json(events, PROPS_SCHEMA, passthrough=["event_id"], keep_corrupt=False)


def json_roundtrip(spark, d):
    events = _t(spark, d, "events")
    wire = encode_json(events)                                   # row -> JSON -> UTF-8 bytes
    return decode_json(wire, events.schema, keep_corrupt=False)  # bytes -> text -> row


def flatten_nested(spark, d):
    wire = encode_json(_nested_events(_t(spark, d, "events")), as_bytes=False)
    docs = decode_json(wire, EVENT_NESTED, keep_corrupt=False)
    return flatten(docs, EVENT_PATHS)


QUARANTINE_SCHEMA = T.StructType([T.StructField("id", T.StringType()),
                                  T.StructField("t", T.DoubleType())])


def _payloads(events: DataFrame) -> DataFrame:
    """Wire payloads with every failure kind, chosen by event type: not JSON
    (error), no id (signup), wrong-typed field (purchase), clean (others)."""
    good = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"),
                              F.col("value").alias("t")))
    return events.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("garbage-"), "event_id"))
         .when(F.col("event_type") == "signup", F.to_json(F.struct(F.col("value").alias("t"))))
         .when(F.col("event_type") == "purchase",
               F.to_json(F.struct(F.col("event_id").cast("string").alias("id"),
                                  F.concat(F.lit("x"), "value").alias("t"))))
         .otherwise(good).cast("binary").alias("value"))


def quarantine_split(spark, d):
    decoded = split_valid(decode_json(_payloads(_t(spark, d, "events")), QUARANTINE_SCHEMA))
    return decoded.groupBy(ROUTE_COL).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# Streaming (O-06, O-08, O-34, O-44..O-50)
# --------------------------------------------------------------------------

def landing_ingest(spark, d):
    """Nested documents land as JSON files; a file stream (one file per
    micro-batch) flattens them into an idempotent batch-keyed sink."""
    landing = shared_path(spark, "landing", "events")
    (_nested_events(_t(spark, d, "events")).repartition("meta.event_id")
        .write.option("timestampNTZFormat", NTZ_JSON_FORMAT).json(landing))
    stream = landing_source(spark, landing, EVENT_NESTED)
    sink = shared_path(spark, "sink", "landing_events")
    q = run_ingest(flatten(stream, EVENT_PATHS), sink, shared_path(spark, "checkpoints", "landing"),
                   decode=False, trigger="availableNow")
    q.awaitTermination()
    return read_sink(spark, sink).drop("batch_id", "written_at")


def stream_ingest(spark, d):
    """Wire records (Kafka-shaped ``value`` bytes) stream from a folder,
    are decoded against the declared schema, routed, and written per batch."""
    events = _t(spark, d, "events")
    topic = shared_path(spark, "topic", "events")
    encode_json(events).repartition(F.xxhash64("value")).write.parquet(topic)
    wire = record_source(spark, topic, T.StructType([T.StructField("value", T.BinaryType())]),
                         max_files_per_trigger=4)
    sink = shared_path(spark, "sink", "events")
    q = run_ingest(wire, sink, shared_path(spark, "checkpoints", "events"), schema=events.schema,
                   required=["event_id"], trigger="availableNow")
    q.awaitTermination()
    return latest_by_key(read_sink(spark, sink), "event_id").drop("batch_id", "written_at")


def stream_dedupe(spark, d):
    """Every event arrives twice (two sources on the same files); keyed
    in-stream dedup keeps one."""
    events = _t(spark, d, "events")
    path = f"{d.rstrip('/')}"
    src = lambda: (spark.readStream.schema(events.schema)
                   .option("pathGlobFilter", "events.parquet").parquet(path))
    doubled = src().unionByName(src())
    # Both copies arrive in the same micro-batch; the delay bounds the dedup
    # state (rows older than the watermark in LATER batches are dropped).
    deduped = dedupe_stream(doubled, "event_id", "ts", delay="1 day")
    sink = shared_path(spark, "sink", "dedup_events")
    q = run_ingest(deduped, sink, shared_path(spark, "checkpoints", "dedup"), decode=False,
                   trigger="availableNow")
    q.awaitTermination()
    return read_sink(spark, sink).drop("batch_id", "written_at")


def stream_dedupe_lossless(spark, d):
    """Every event comes twice, in micro-batches up to all others apart and without
    any order in time: each is kept once, none is dropped as late."""
    events = _t(spark, d, "events")
    folder = shared_path(spark, "topic", "events_twice")
    for part in range(2):  # the second copies come after all the first ones
        events.repartition(3, F.xxhash64("event_id", F.lit(part))).write.mode("append").parquet(folder)
    sink = shared_path(spark, "sink", "lossless")
    q = dedupe_lossless(
        record_source(spark, folder, events.schema, max_files_per_trigger=1), "event_id",
        shared_path(spark, "seen", "events"), shared_path(spark, "checkpoints", "lossless"),
        functools.partial(write_batch, sink=sink), trigger="availableNow")
    q.awaitTermination()
    return read_sink(spark, sink).drop("batch_id", "written_at")


def _user_rows(events: DataFrame) -> DataFrame:
    return events.select("user_id", "ts", "event_id", "event_type", "value")


def keyed_upsert(spark, d):
    """The latest event of every user, in a keyed table that five batches of events
    update, out of order in time, with one compaction between them."""
    rows = _user_rows(_t(spark, d, "events"))
    table = KeyedTable.create(spark, shared_path(spark, "tables", "users"), rows.schema, "user_id",
                              order=["ts", "event_id"], buckets=16)
    for batch, part in enumerate((3, 0, 4, 1, 2)):
        table.upsert(rows.filter(F.col("event_id") % 5 == part), writer="loader", batch=batch)
        if batch == 2:
            table.compact()
    return table.read()


def stream_upsert(spark, d):
    """The same by a stream of wire records; payloads that do not decode go aside."""
    events = _t(spark, d, "events")
    topic = shared_path(spark, "topic", "user_events")
    wire = encode_json(_user_rows(events)).unionByName(
        events.filter("event_type = 'error'").select(
            F.concat(F.lit("garbage-"), "event_id").cast("binary").alias("value")))
    wire.repartition(3, F.xxhash64("value")).write.parquet(topic)
    table = KeyedTable.create(spark, shared_path(spark, "tables", "user_stream"),
                              _user_rows(events).schema, "user_id", order=["ts", "event_id"],
                              buckets=8)
    q = run_upsert(record_source(spark, topic, T.StructType([T.StructField("value", T.BinaryType())]),
                                 max_files_per_trigger=1),
                   table, shared_path(spark, "checkpoints", "user_stream"),
                   schema=_user_rows(events).schema, trigger="availableNow",
                   quarantine=shared_path(spark, "sink", "user_quarantine"))
    q.awaitTermination()
    return table.read()


def _weather_documents(events: DataFrame, *keep: str) -> DataFrame:
    """Nested weather documents, one per event."""
    minute = F.date_format("ts", "yyyy-MM-dd H:mm")
    number = lambda m: F.pmod(F.col("event_id"), F.lit(m))
    return events.select(
        *keep,
        F.struct(F.concat(F.lit("city"), "user_id").alias("name"),
                 F.concat(F.lit("region"), number(7)).alias("region"),
                 F.col("event_type").alias("country"), minute.alias("localtime")).alias("location"),
        F.struct(F.col("value").cast("float").alias("temp_c"), minute.alias("last_updated"),
                 F.struct(F.col("event_type").alias("text"),
                          F.concat(F.lit("//icons/"), number(9), F.lit(".png")).alias("icon")
                          ).alias("condition"),
                 number(360).cast("int").alias("wind_degree"),
                 number(100).cast("int").alias("humidity")).alias("current"))


def produce_observations(spark, d):
    """Nested documents land as files -> a stream flattens them, gives them ids and
    writes JSON records to a log -> a second stream reads the log, decodes the
    records and writes typed rows. (Documents of one place and minute share an id.)"""
    landing = shared_path(spark, "landing", "documents")
    _weather_documents(_t(spark, d, "events")).repartition(2).write.json(landing)
    topic = shared_path(spark, "topic", "observations")
    stream_log(produce(landing_source(spark, landing, WEATHER_NESTED, keep_corrupt=True)), topic,
               shared_path(spark, "checkpoints", "producer"), writer="producer", partitions=3,
               trigger="availableNow").awaitTermination()
    sink = shared_path(spark, "sink", "observations")
    run_ingest(log_source(spark, topic), sink, shared_path(spark, "checkpoints", "observations"),
               transform=to_sink_types, trigger="availableNow").awaitTermination()
    rows = read_sink(spark, sink)
    return rows.groupBy("id", "location_city", "location_region", "location_country", "localtime",
                        "last_updated", "description").agg(
        F.count(F.lit(1)).alias("n"), F.min("icon").alias("icon"),
        F.min("wind_degree").alias("wind_degree"), F.max("humidity").alias("humidity"),
        F.max(F.col("current_temp_c").cast("decimal(12,2)")).alias("temp_c"))


def _keyed_wire(events: DataFrame) -> DataFrame:
    key = F.col("user_id").cast("string").cast("binary")
    return encode_json(events.withColumn("key", key), events.columns, keep=["key"])


def log_from_offsets(spark, d):
    """A log read from explicit offsets: the events that were added after the first
    half, in a stream whose second run finds nothing new."""
    events = _t(spark, d, "events")
    log = shared_path(spark, "topic", "from_offsets")
    append_log(_keyed_wire(events.filter("event_id % 2 = 0")), log, partitions=3)
    middle = Log(log).latest()["ends"]
    append_log(_keyed_wire(events.filter("event_id % 2 = 1")), log)
    sink, ckpt = shared_path(spark, "sink", "offsets"), shared_path(spark, "checkpoints", "offsets")
    for _ in range(2):
        run_ingest(log_source(spark, log, starting_offsets=middle), sink, ckpt,
                   schema=events.schema, required=["event_id"],
                   trigger="availableNow").awaitTermination()
    return read_sink(spark, sink).drop("batch_id", "written_at")


def log_latest_and_restart(spark, d):
    """A stream that starts at the end of a log sees what is added later; after a
    restart its checkpoint counts, whatever start position it is given."""
    events = _t(spark, d, "events")
    log = shared_path(spark, "topic", "latest")
    append_log(_keyed_wire(events.filter("event_id % 3 = 0")), log, partitions=2)
    sink, ckpt = shared_path(spark, "sink", "latest"), shared_path(spark, "checkpoints", "latest")
    for start, part in (("latest", 1), ("earliest", 2)):
        run_ingest(log_source(spark, log, starting_offsets=start), sink, ckpt,
                   schema=events.schema, required=["event_id"],
                   trigger="availableNow").awaitTermination()
        append_log(_keyed_wire(events.filter(F.col("event_id") % 3 == part)), log)
    run_ingest(log_source(spark, log), sink, ckpt, schema=events.schema, required=["event_id"],
               trigger="availableNow").awaitTermination()
    return read_sink(spark, sink).drop("batch_id", "written_at")


def log_offsets(spark, d):
    """The offsets of a log run without gaps in every partition, and a key has one
    partition, over three appends."""
    events = _t(spark, d, "events")
    log = shared_path(spark, "topic", "offsets")
    for part in range(3):
        append_log(_keyed_wire(events.filter(F.col("event_id") % 3 == part)), log, partitions=4)
    records = read_log(spark, log)
    per = records.groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"),
        F.count_distinct("offset").alias("k"), F.count_distinct("key").alias("keys"))
    return per.agg(F.sum("n").alias("n_records"), F.sum("keys").alias("n_keys"),
                   F.sum(((F.col("lo") == 0) & (F.col("hi") + 1 == F.col("n"))
                          & (F.col("k") == F.col("n"))).cast("int")).alias("whole"),
                   F.count(F.lit(1)).alias("n_partitions")).select(
        "n_records", "n_keys", (F.col("whole") == F.col("n_partitions")).alias("gapless"))


def landing_quarantine(spark, d):
    """Documents land as JSON lines, some of which are none: text, ``{}``, an array.
    They are kept apart, with their raw text, and get no id."""
    landing = shared_path(spark, "landing", "weather")
    kind = F.col("event_type")
    document = F.to_json(F.struct("location", "current"))
    lines = _weather_documents(_t(spark, d, "events"), "event_id", "event_type").select(
        F.when(kind == "error", F.concat(F.lit("garbage-"), "event_id"))
        .when(kind == "signup", F.lit("{}")).when(kind == "purchase", F.lit("[1]"))
        .otherwise(document).alias("value"))
    lines.repartition(3, F.xxhash64("value")).write.text(landing)
    sink = shared_path(spark, "sink", "weather")
    q = run_ingest(observations(landing_source(spark, landing, WEATHER_NESTED, keep_corrupt=True)),
                   sink, shared_path(spark, "checkpoints", "weather"), decode=False,
                   trigger="availableNow")
    q.awaitTermination()
    return read_sink(spark, sink, route=None).groupBy(ROUTE_COL).agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("n_ids"),
        F.count("_corrupt_record").alias("n_raw"),
        F.min("_corrupt_record").alias("first_raw"), F.max("location_city").alias("last_city"))


def batch_ledger(spark, d):
    """The ledger of a stream of several micro-batches agrees with its sink, without a
    job of its own."""
    events = _t(spark, d, "events")
    topic = shared_path(spark, "topic", "ledger")
    encode_json(events).repartition(3, F.xxhash64("value")).write.parquet(topic)
    sink, path = shared_path(spark, "sink", "ledger"), shared_path(spark, "ledger")
    name = _name("ledger")
    ledger = BatchLedger(spark, path, queries=(name,))
    spark.streams.addListener(ledger)
    try:
        run_ingest(record_source(spark, topic, T.StructType([T.StructField("value", T.BinaryType())]),
                                 max_files_per_trigger=1),
                   sink, shared_path(spark, "checkpoints", "ledger"), schema=events.schema,
                   required=["event_id"], trigger="availableNow",
                   query_name=name).awaitTermination()
        ledger.flush()
    finally:
        spark.streams.removeListener(ledger)
    entries = read_ledger(spark, path)
    rows = spark.read.parquet(sink).select("query_id", "batch_id")
    off = ledger_against_sink(entries, rows).agg(F.count(F.lit(1)).alias("mismatches"))
    return entries.agg(F.sum("rows").alias("n_rows"),
                       (F.count(F.lit(1)) > 1).alias("several_batches")).withColumn(
        "mismatches", off.scalar())


def _spelt(col: str):
    """A text in mixed case and with accents, by its row."""
    by = F.col("o_orderkey") % 3
    return (F.when(by == 0, F.lower(col)).when(by == 1, F.translate(col, "EIO", "\u00c9\u00ce\u00d6"))
            .otherwise(F.col(col)).alias(col))


def collated_totals(spark, d):
    """Totals by a text key that compares without regard to case and accents, as a
    server's default collation has it."""
    orders = _t(spark, d, "orders").select(_spelt("o_orderpriority"), "o_custkey")
    return A.total_by(orders, "o_orderpriority", "o_custkey", out="total", collation="UNICODE_CI_AI")


def collated_dedupe(spark, d):
    """One order per customer and priority, the latest, whatever the spelling."""
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", _spelt("o_orderpriority"))
    return C.dedupe(orders, ["o_custkey", "o_orderpriority"], order="-o_orderkey",
                    collation="UNICODE_CI_AI")


def schema_evolution(spark, d):
    """A table whose columns change between three inserts: a default fills a column
    that is not given, a text column becomes a number, a column is added and one
    renamed. The files of the first insert are read under the last columns."""
    orders = _t(spark, d, "orders")
    part = lambda i: orders.filter(F.col("o_orderkey") % 3 == i)
    table = EvolvingTable.create(spark, shared_path(spark, "tables", "orders"), [
        Field("key", "bigint", nullable=False), Field("customer", "string"),
        Field("status", "string", nullable=False, default="'?'"), Field("total", "double")])
    named = [F.col("o_orderkey").alias("key"), F.col("o_custkey").cast("string").alias("customer")]
    table.insert(part(0).select(*named, F.col("o_totalprice").alias("total")))
    table.modify("customer", "bigint")
    table.add(Field("priority", "string", default="'none'"))
    table.insert(part(1).select(*named, F.col("o_orderstatus").alias("status"),
                                F.col("o_orderpriority").alias("priority")))
    table.rename("total", "price")
    table.insert(part(2).select(*named, F.col("o_totalprice").alias("price")))
    return table.read()


def latest_by_key_q(spark, d):
    return latest_by_key(_t(spark, d, "orders"), "o_custkey", ["-o_orderdate", "-o_orderkey"])


# --------------------------------------------------------------------------
# Composite jobs on a layoffs-shaped table derived from orders x customer
# --------------------------------------------------------------------------

def _layoffs_shaped(spark, d) -> DataFrame:
    """orders x customer -> the nine raw layoffs columns, with the dirt the
    cleaning job exists for: padded names, Crypto* variants, blanks, trailing
    dots, text dates and percentages, NULL measures, and exact copies."""
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    raw = j.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit(" "), "c_name"))
         .otherwise(F.col("c_name")).alias("company"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("location"),
        F.when(F.col("o_orderstatus") == "P", F.lit(""))
         .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("Crypto"), "o_orderstatus"))
         .otherwise(F.col("c_mktsegment")).alias("industry"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("int"))
         .otherwise(F.floor(F.col("o_totalprice") / 1000).cast("int")).alias("total_laid_off"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"),
               F.lit(None).cast("string"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("1"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("1.0"))
         .otherwise(F.lit("0.5")).alias("percentage_laid_off"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("date"),
        F.col("o_orderpriority").alias("stage"),
        F.when(F.col("c_nationkey") < 3, F.lit("United States."))
         .when(F.col("c_nationkey") < 6, F.lit("United States"))
         .otherwise(F.concat(F.lit("Nation"), F.col("c_nationkey").cast("string"), F.lit(".")))
         .alias("country"),
        F.floor("c_acctbal").cast("int").alias("funds_raised_millions"),
    )
    copies = raw.filter((F.col("stage") == "2-HIGH") & (F.col("industry") == "BUILDING"))
    return raw.unionByName(copies).select(*LAYOFFS_COLUMNS)


def clean_layoffs(spark, d):
    return clean(_layoffs_shaped(spark, d), CleanSpec())


def running_total_rows(spark, d):
    """Every line item with the quantity shipped up to its day: the order values
    repeat and other columns are carried along."""
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate",
                                           _qty().alias("qty"))
    return A.running_total(rows, "l_shipdate", "qty", out="shipped")


_CLEANED: dict[tuple, str] = {}


def _stamp(spark, path: str) -> tuple:
    """Names, sizes and times of the files under a path: another one means other rows."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(root, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _cleaned_table(spark, d) -> DataFrame:
    """The cleaned layoffs-shaped table, written once per session and state of the
    source files under the shared folder -- the exploration queries read the
    persisted cleaned table, as the original exploration script does."""
    base = d.rstrip("/")
    key = (spark.sparkContext.applicationId, base,
           *[_stamp(spark, f"{base}/{t}.parquet") for t in ("orders", "customer")])
    path = _CLEANED.get(key)
    if path is None:
        path = shared_path(spark, "tables", "layoffs_clean")
        clean(_layoffs_shaped(spark, d)).write.parquet(path)
        _CLEANED[key] = path
    return spark.read.schema(LAYOFFS_CLEAN).parquet(path)


def _explore(name: str) -> QueryFn:
    def run(spark, d):
        from .exploration import explore

        return explore(_cleaned_table(spark, d))[name]

    run.__name__ = f"explore_{name}"
    return run


QUERIES: dict[str, QueryFn] = {
    "stage_copy": stage_copy,
    "stage_numbered": stage_numbered,
    "dedup_documents": dedup_documents,
    "dedup_text_lang": dedup_text_lang,
    "dedup_orders": dedup_orders,
    "number_duplicates": number_duplicates,
    "delete_where": delete_where,
    "drop_all_null": drop_all_null,
    "trim_names": trim_names,
    "canonical_brand": canonical_brand,
    "strip_dots": strip_dots,
    "blank_to_null": blank_to_null,
    "fill_from_peers": fill_from_peers,
    "parse_date": parse_date,
    "text_equals_one": text_equals_one,
    "total_by_flag": total_by_flag,
    "total_by_year": total_by_year,
    "total_by_month": total_by_month,
    "running_total": running_total,
    "total_by_supplier_year": total_by_supplier_year,
    "order_date_span": order_date_span,
    "top5_supplier_year": top5_supplier_year,
    "decode_props": decode_props,
    "json_roundtrip": json_roundtrip,
    "flatten_nested": flatten_nested,
    "quarantine_split": quarantine_split,
    "landing_ingest": landing_ingest,
    "stream_ingest": stream_ingest,
    "stream_dedupe": stream_dedupe,
    "stream_dedupe_lossless": stream_dedupe_lossless,
    "keyed_upsert": keyed_upsert,
    "stream_upsert": stream_upsert,
    "produce_observations": produce_observations,
    "landing_quarantine": landing_quarantine,
    "log_from_offsets": log_from_offsets,
    "log_latest_and_restart": log_latest_and_restart,
    "log_offsets": log_offsets,
    "batch_ledger": batch_ledger,
    "collated_totals": collated_totals,
    "collated_dedupe": collated_dedupe,
    "schema_evolution": schema_evolution,
    "latest_by_key": latest_by_key_q,
    "clean_layoffs": clean_layoffs,
    "running_total_rows": running_total_rows,
    "explore_all_rows": _explore("all_rows"),
    "explore_full_layoffs": _explore("full_layoffs"),
    "explore_total_by_company": _explore("total_by_company"),
    "explore_date_span": _explore("date_span"),
    "explore_total_by_industry": _explore("total_by_industry"),
    "explore_total_by_year": _explore("total_by_year"),
    "explore_total_by_stage": _explore("total_by_stage"),
    "explore_total_by_month": _explore("total_by_month"),
    "explore_rolling_total": _explore("rolling_total"),
    "explore_total_by_company_year": _explore("total_by_company_year"),
    "explore_top_companies": _explore("top_companies_per_year"),
}
