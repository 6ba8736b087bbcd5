import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions.json import (CORRUPT_COL, decode_json, encode_json, flatten_observation,
                                      split_valid)
from scrubline.schemas import WEATHER_FLAT, WEATHER_NESTED, WEATHER_SINK
from scrubline.streaming.ingest import to_sink_types

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("t", T.FloatType()),
                       T.StructField("h", T.IntegerType())])


def test_payload_routes(spark):
    payloads = ['{"id":"a","t":1.5,"h":3}', '{"t":1.5}', "garbage", '{"id":"a","t":"x","h":3}',
                '{"id":"b","t":12,"h":3.0}', '[{"id":"z"}]', None]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    out = split_valid(decode_json(df, SCHEMA)).collect()
    got = [(r.id, r.t, r.h, r[CORRUPT_COL] is not None, r.route) for r in out]
    assert got == [
        ("a", 1.5, 3, False, "valid"),
        (None, 1.5, None, False, "quarantine"),
        (None, None, None, True, "quarantine"),
        ("a", None, 3, True, "quarantine"),
        ("b", 12.0, None, True, "quarantine"),
        (None, None, None, True, "quarantine"),
        (None, None, None, False, "quarantine"),
    ]


def test_encode_decode_roundtrip_keeps_micros_and_nulls(spark):
    schema = "id long, ts timestamp_ntz, s string, d double"
    data = [(1, datetime(2024, 1, 1, 0, 0, 7, 179575), "x", 6.55), (2, None, None, None)]
    df = spark.createDataFrame(data, schema)
    wire = encode_json(df)
    assert wire.schema["value"].dataType == T.BinaryType()
    first = json.loads(bytes(wire.first().value).decode("utf-8"))
    assert first["ts"] == "2024-01-01T00:00:07.179575"
    second = json.loads(bytes(wire.collect()[1].value).decode())
    assert second["s"] is None  # NULL written as null, like json.dumps
    back = decode_json(wire, df.schema, keep_corrupt=False)
    assert [tuple(r) for r in back.collect()] == data


def test_flatten_observation_paths_ids_and_missing(spark):
    doc = {"location": {"name": "Springfield", "region": "Central", "country": "France",
                        "localtime": "2025-06-04 8:42"},
           "current": {"temp_c": 21.5, "last_updated": "2025-06-04 18:30",
                       "condition": {"text": "Sunny", "icon": "//x.png"}, "feelslike_c": 21.0,
                       "wind_kph": 5.4, "wind_degree": 250, "pressure_mb": 1015.0, "humidity": 40,
                       "heatindex_c": 22.0, "dewpoint_c": 7.5, "vis_km": 10.0, "uv": 6.0,
                       "gust_kph": 8.1}}
    partial = {"location": {"name": "Nowhere"}}
    df = spark.read.schema(WEATHER_NESTED).json(
        spark.sparkContext.parallelize([json.dumps(doc), json.dumps(partial)]))
    flat = flatten_observation(df)
    assert flat.columns == WEATHER_FLAT.fieldNames()
    a, b = flat.collect()
    assert (a.location_city, a.description, a.icon, a.wind_degree, a.humidity) == \
        ("Springfield", "Sunny", "//x.png", 250, 40)
    assert b.location_city == "Nowhere" and b.current_temp_c is None and b.description is None
    assert len(a.id) == 36 and a.id == flatten_observation(df).first().id  # stable on re-run
    rnd = flatten_observation(df, id_mode="random").first().id
    assert len(rnd) == 36
    typed = to_sink_types(flat)
    assert [(f.name, f.dataType) for f in typed.schema] == \
        [(f.name, f.dataType) for f in WEATHER_SINK]
    t = typed.first()
    assert t.localtime == datetime(2025, 6, 4, 8, 42) and t.last_updated == datetime(2025, 6, 4, 18, 30)


def test_decode_plan_has_single_from_json(spark):
    df = spark.createDataFrame([('{"id":"a","t":1.0,"h":1}',)], "value string")
    out = decode_json(df, SCHEMA).select("id", "t")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_parse_timestamp_ntz_ignores_session_zone(spark):
    from scrubline.functions.dates import parse_timestamp

    df = spark.createDataFrame([("2025-03-30 2:30",), ("2025-06-04 18:42",), ("bad",), (None,)],
                               "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")  # 2:30 falls in a DST gap
        got = [r.t for r in df.select(parse_timestamp("t", "yyyy-MM-dd H:mm").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [datetime(2025, 3, 30, 2, 30), datetime(2025, 6, 4, 18, 42), None, None]
