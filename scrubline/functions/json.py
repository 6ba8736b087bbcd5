"""JSON wire format: encode rows to bytes, decode bytes against a declared
schema (bad payloads kept and routed, never silently dropped), and flatten
nested documents to named columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NTZ_JSON_FORMAT

CORRUPT_COL = "_corrupt_record"
ROUTE_COL = "route"
VALID, QUARANTINE = "valid", "quarantine"


def _json_options(keep_nulls: bool, ts_format: str) -> dict[str, str]:
    return {
        "timestampNTZFormat": ts_format,
        "timestampFormat": ts_format + "XXX",
        "ignoreNullFields": "false" if keep_nulls else "true",
    }


def encode_json(df: DataFrame, cols: Sequence[str] | None = None, *,
                keep_nulls: bool = True, ts_format: str = NTZ_JSON_FORMAT,
                as_bytes: bool = True, out_col: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Each row -> one JSON object (UTF-8 bytes by default) in ``out_col``, after the
    columns ``keep`` (such as a record's key).

    Timestamps keep microseconds; NULL fields are written as ``null`` unless
    ``keep_nulls=False``."""
    cols = list(cols) if cols is not None else df.columns
    text = F.to_json(F.struct(*[F.col(c) for c in cols]), _json_options(keep_nulls, ts_format))
    return df.select(*keep, (text.cast("binary") if as_bytes else text).alias(out_col))


def decode_json(df: DataFrame, schema: T.StructType, *, value_col: str = "value",
                keep_corrupt: bool = True, ts_format: str = NTZ_JSON_FORMAT,
                passthrough: Sequence[str] = ()) -> DataFrame:
    """JSON text/bytes in ``value_col`` -> the declared columns.

    PERMISSIVE parse: malformed payloads give all-NULL fields and a non-NULL
    ``_corrupt_record``; a wrong-typed field gives NULL in that field and
    also sets ``_corrupt_record``. ``passthrough`` columns (e.g. Kafka
    ``offset``) are carried alongside."""
    if CORRUPT_COL in schema.fieldNames():
        raise ValueError(f"schema must not contain {CORRUPT_COL}")
    parse_schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL,
            "timestampNTZFormat": ts_format, "timestampFormat": ts_format + "XXX"}
    text = F.col(value_col).cast("string")
    out = df.select(*passthrough, F.from_json(text, parse_schema, opts).alias("_data"))
    out = out.select(*passthrough, "_data.*")
    return out if keep_corrupt else out.drop(CORRUPT_COL)


def split_valid(decoded: DataFrame, required: Sequence[str] = ("id",)) -> DataFrame:
    """Tag each decoded row ``valid`` or ``quarantine``.

    A row is valid when it parsed cleanly (no corrupt record, if ``decoded`` has that
    column) and every ``required`` field is present. A missing key does *not* set the corrupt
    record column, so it is tested separately. Rows are tagged, not split into
    two jobs, so one pass over the batch serves both destinations."""
    ok = F.col(CORRUPT_COL).isNull() if CORRUPT_COL in decoded.columns else F.lit(True)
    for r in required:
        ok = ok & F.col(r).isNotNull()
    return decoded.withColumn(ROUTE_COL, F.when(ok, F.lit(VALID)).otherwise(F.lit(QUARANTINE)))


def flatten(df: DataFrame, paths: Mapping[str, str], *, keep: Sequence[str] = (),
            key: Column | None = None, key_name: str = "id") -> DataFrame:
    """Nested document -> flat columns ``{out_name: "a.b.c"}`` in mapping order.

    A path that is missing in a document gives NULL (a struct field access on
    NULL is NULL). ``key`` prepends a generated key column."""
    sel = [F.col(c) for c in keep]
    if key is not None:
        sel.append(key.alias(key_name))
    sel += [F.col(p).alias(n) for n, p in paths.items()]
    return df.select(*sel)


def stable_uuid(*cols: Column | str) -> Column:
    """UUID-shaped id derived from a SHA-256 of the given columns.

    Unlike ``uuid()`` it is the same every time a task is re-run, so a
    recomputed partition (lost executor, replayed batch) writes the same ids.
    NULL if all columns are NULL: there is nothing to make an id from."""
    given = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    h = F.sha2(F.concat_ws("\u0001", *[F.coalesce(g, F.lit("\u0000")) for g in given]), 256)
    any_ = F.coalesce(*given).isNotNull()
    return F.when(any_, F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12)))


def flatten_observation(df: DataFrame, *, id_mode: str = "stable",
                        id_from: Sequence[str] | None = None) -> DataFrame:
    """Nested weather document -> the flat 19-field observation.

    ``id_mode="stable"`` (default) derives the id from the natural key
    (place + observation times) so replays are idempotent; ``"random"`` gives a
    fresh UUID v4 per row, as a one-shot producer would. Either is NULL for a
    document without any of the natural key. ``_corrupt_record`` is carried along."""
    from ..schemas import WEATHER_FIELD_PATHS

    natural = id_from or ["location.name", "location.region", "location.country",
                          "location.localtime", "current.last_updated"]
    if id_mode == "random":
        key = F.when(F.coalesce(*[F.col(c).cast("string") for c in natural]).isNotNull(),
                     F.expr("uuid()"))
    elif id_mode == "stable":
        key = stable_uuid(*natural)
    else:
        raise ValueError(f"unknown id_mode {id_mode!r}")
    keep = [c for c in (CORRUPT_COL,) if c in df.columns]
    return flatten(df, WEATHER_FIELD_PATHS, keep=keep, key=key, key_name="id")
