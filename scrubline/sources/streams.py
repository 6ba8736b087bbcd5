"""Streaming sources: Kafka (where its connector is on the classpath), a
directory of wire records with the Kafka ``value`` column, and a landing
directory of JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.json import CORRUPT_COL
from ..schemas import WEATHER_NESTED


def kafka_source(spark: SparkSession, servers: str, topic: str, *,
                 starting_offsets: str = "latest", group_id: str | None = None,
                 max_offsets_per_trigger: int | None = None, **options: str) -> DataFrame:
    """``readStream.format("kafka")``. ``startingOffsets`` only applies to a
    query without a checkpoint; afterwards the checkpoint decides. Bound each
    micro-batch with ``max_offsets_per_trigger`` on large topics. Fails loudly
    when the connector is missing (never returns ``None``)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.options(**options).load()


def record_source(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """File stream of records (e.g. Parquet with a binary ``value`` column --
    the same shape a Kafka source yields). ``path`` must be a directory;
    ``glob`` selects files inside it."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def landing_source(spark: SparkSession, path: str, schema: T.StructType = WEATHER_NESTED, *,
                   max_files_per_trigger: int | None = None,
                   keep_corrupt: bool = False) -> DataFrame:
    """Documents landing as JSON files (one or more documents per file, one per
    line) streamed with a declared nested schema -- the distributed stand-in
    for polling a REST endpoint. ``keep_corrupt`` adds ``_corrupt_record``, the raw
    text of what is not such a document, so that it can be quarantined."""
    if keep_corrupt and CORRUPT_COL not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    return record_source(spark, path, schema, fmt="json",
                         max_files_per_trigger=max_files_per_trigger)


def stream_source(spark: SparkSession, kind: str = "kafka", **kw) -> DataFrame:
    """Dispatch: ``kafka`` | ``records`` | ``landing``."""
    if kind == "kafka":
        return kafka_source(spark, **kw)
    if kind == "records":
        return record_source(spark, **kw)
    if kind == "landing":
        return landing_source(spark, **kw)
    raise ValueError(f"unknown source kind {kind!r}")
