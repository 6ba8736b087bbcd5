"""J-4 then J-3 on weather documents: nested JSON lands as files, is
flattened and encoded to wire bytes (produce), written to a topic folder,
then decoded, typed and written per micro-batch (ingest)."""

import json
import logging

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.plans import produce
from scrubline.schemas import WEATHER_FLAT, WEATHER_NESTED, WEATHER_SINK
from scrubline.session import shared_path
from scrubline.sources.streams import kafka_source, landing_source, record_source
from scrubline.streaming.ingest import (latest_by_key, read_sink, run_ingest, stream_sink,
                                        to_sink_types, write_batch)

WIRE = T.StructType([T.StructField("value", T.BinaryType())])


def _doc(i, city="Springfield"):
    return {"location": {"name": city, "region": "Central", "country": "France",
                         "localtime": f"2025-06-04 {i % 24}:{i % 60:02d}"},
            "current": {"temp_c": 20.0 + i, "last_updated": f"2025-06-04 {i % 24}:00",
                        "condition": {"text": "Sunny", "icon": "//icon.png"},
                        "feelslike_c": 19.5, "wind_kph": 5.0, "wind_degree": 250,
                        "pressure_mb": 1015.0, "humidity": 40, "heatindex_c": 21.0,
                        "dewpoint_c": 7.0, "vis_km": 10.0, "uv": 6.0, "gust_kph": 8.0}}


def test_produce_then_ingest_weather(spark, tmp_path):
    landing = shared_path(spark, "w_landing")
    docs = [json.dumps(_doc(i)) for i in range(30)]
    docs.append(json.dumps(_doc(3)))  # the same observation polled twice
    spark.createDataFrame([(d,) for d in docs], "value string").repartition(3) \
        .write.text(landing)

    # J-4 as a stream: landing documents -> flat record -> JSON bytes -> topic folder
    topic = shared_path(spark, "w_topic")
    q = stream_sink(produce(landing_source(spark, landing, WEATHER_NESTED)),
                    shared_path(spark, "w_ckpt_p"), kind="files", path=topic,
                    trigger="availableNow")
    q.awaitTermination()
    assert spark.read.parquet(topic).count() == 31

    # J-3: topic -> decode -> typed -> batch sink
    sink = shared_path(spark, "w_sink")
    run_ingest(record_source(spark, topic, WIRE), sink, shared_path(spark, "w_ckpt_i"),
               schema=WEATHER_FLAT, transform=to_sink_types,
               trigger="availableNow").awaitTermination()
    got = read_sink(spark, sink)
    assert [(f.name, f.dataType) for f in got.drop("batch_id", "written_at").schema] == \
        [(f.name, f.dataType) for f in WEATHER_SINK]
    assert got.count() == 31
    # The repeated poll has the same stable id; keep-latest leaves one row per id.
    assert latest_by_key(got, "id").count() == 30
    assert got.filter(F.col("localtime").isNull()).count() == 0


def test_weather_quarantine(spark):
    good = json.dumps({"id": "a", "location_city": "X", "humidity": 4})
    bad = [json.dumps({"location_city": "no id"}), "{not json", json.dumps({"id": "b",
                                                                            "humidity": 4.5})]
    wire = spark.createDataFrame([(p.encode(),) for p in [good, *bad]], WIRE)
    sink = shared_path(spark, "wq_sink")
    from scrubline.streaming.ingest import decode_stream

    assert write_batch(decode_stream(wire), 0, sink, route_col="route") == 4
    assert read_sink(spark, sink).count() == 1
    assert read_sink(spark, sink, route="quarantine").count() == 3


def test_kafka_source_fails_loudly_without_connector(spark):
    with pytest.raises(Exception) as e:
        kafka_source(spark, "broker:29092", "weather_data", starting_offsets="latest",
                     group_id="g")
    assert "kafka" in str(e.value).lower()


def test_preview_is_logged(spark, caplog):
    sink = shared_path(spark, "preview")
    with caplog.at_level(logging.INFO, logger="scrubline.streaming.ingest"):
        write_batch(spark.range(5), 3, sink, preview=2)
    assert any("preview" in r.message for r in caplog.records)


def test_produce_id_modes(spark):
    docs = spark.read.schema(WEATHER_NESTED).json(
        spark.sparkContext.parallelize([json.dumps(_doc(1)), json.dumps(_doc(1))]))
    stable = [json.loads(bytes(r.value))["id"] for r in produce(docs).collect()]
    assert stable[0] == stable[1]  # same observation, same id: replays are idempotent
    rnd = [json.loads(bytes(r.value))["id"] for r in produce(docs, id_mode="random").collect()]
    assert rnd[0] != rnd[1] and all(len(i) == 36 for i in rnd)
    with pytest.raises(ValueError):
        produce(docs, id_mode="nope")
