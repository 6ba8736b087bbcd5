"""Declared schemas. Nothing in the library infers a schema."""

from pyspark.sql import types as T

# Raw layoffs table: nine columns in this order (the copy into the numbered
# staging table is positional, so the order is part of the contract).
LAYOFFS_COLUMNS = [
    "company", "location", "industry", "total_laid_off", "percentage_laid_off",
    "date", "stage", "country", "funds_raised_millions",
]

LAYOFFS_RAW = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("total_laid_off", T.IntegerType()),
    T.StructField("percentage_laid_off", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("funds_raised_millions", T.IntegerType()),
])

# Cleaned: same columns, `date` retyped to DATE.
LAYOFFS_CLEAN = T.StructType([
    f if f.name != "date" else T.StructField("date", T.DateType()) for f in LAYOFFS_RAW.fields
])

# Nested weather document as the source API returns it (only the paths used).
WEATHER_NESTED = T.StructType([
    T.StructField("location", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("localtime", T.StringType()),
    ])),
    T.StructField("current", T.StructType([
        T.StructField("temp_c", T.FloatType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("condition", T.StructType([
            T.StructField("text", T.StringType()),
            T.StructField("icon", T.StringType()),
        ])),
        T.StructField("feelslike_c", T.FloatType()),
        T.StructField("wind_kph", T.FloatType()),
        T.StructField("wind_degree", T.IntegerType()),
        T.StructField("pressure_mb", T.FloatType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("heatindex_c", T.FloatType()),
        T.StructField("dewpoint_c", T.FloatType()),
        T.StructField("vis_km", T.FloatType()),
        T.StructField("uv", T.FloatType()),
        T.StructField("gust_kph", T.FloatType()),
    ])),
])

# Output field -> path in the nested document, in record order.
WEATHER_FIELD_PATHS = {
    "location_city": "location.name",
    "location_region": "location.region",
    "location_country": "location.country",
    "localtime": "location.localtime",
    "current_temp_c": "current.temp_c",
    "last_updated": "current.last_updated",
    "description": "current.condition.text",
    "icon": "current.condition.icon",
    "feelslike_c": "current.feelslike_c",
    "wind_kph": "current.wind_kph",
    "wind_degree": "current.wind_degree",
    "pressure_mb": "current.pressure_mb",
    "humidity": "current.humidity",
    "heatindex_c": "current.heatindex_c",
    "dewpoint_c": "current.dewpoint_c",
    "vis_km": "current.vis_km",
    "uv": "current.uv",
    "gust_kph": "current.gust_kph",
}

def _leaf_type(schema: T.StructType, path: str) -> T.DataType:
    dt: T.DataType = schema
    for part in path.split("."):
        dt = dt[part].dataType  # type: ignore[index]
    return dt


# Flat observation as it travels on the wire: id + the 18 fields above.
WEATHER_FLAT = T.StructType(
    [T.StructField("id", T.StringType())]
    + [T.StructField(n, _leaf_type(WEATHER_NESTED, p)) for n, p in WEATHER_FIELD_PATHS.items()]
)

# Sink: same names; the two time fields parsed to zone-less timestamps.
WEATHER_SINK = T.StructType([
    T.StructField(f.name, T.TimestampNTZType()) if f.name in ("localtime", "last_updated") else f
    for f in WEATHER_FLAT.fields
])

# Source-local time format of `localtime` / `last_updated` (hour may be 1 digit).
WEATHER_TIME_FORMAT = "yyyy-MM-dd H:mm"

# Kafka record as Spark's Kafka source produces it.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# JSON text format for zone-less timestamps that keeps microseconds both ways.
NTZ_JSON_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
