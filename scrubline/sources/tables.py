"""Table sources and staging.

``read_table`` scans with a declared schema (never inferred), so Parquet
column pruning and filter pushdown apply. ``stage_table`` / ``stage_like`` /
``insert_into`` are the DDL/DML of a staging area: external Parquet tables
whose files live under the cluster's shared folder (``spark.checkpoint.dir``),
never under a machine-local path or the default warehouse.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import shared_path

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _check(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"bad table name {name!r}")
    return name


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None,
               fmt: str = "parquet", **options: str) -> DataFrame:
    """``SELECT * FROM t``: a catalog table name, or a path read with ``fmt``.
    For text formats (CSV/JSON) a ``schema`` is required."""
    if all(_NAME.match(part) for part in source.split(".")) and spark.catalog.tableExists(source):
        return spark.table(source)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json", "text"):
        raise ValueError(f"{fmt} sources need a declared schema")
    return reader.format(fmt).load(source)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def stage_table(spark: SparkSession, name: str, schema: T.StructType | None = None,
                df: DataFrame | None = None, location: str | None = None) -> DataFrame:
    """``CREATE TABLE name (declared columns)`` -- empty when only ``schema`` is
    given -- or ``CREATE TABLE name AS SELECT`` when ``df`` is given.

    The table is external Parquet at ``location`` (default: a fresh folder
    under the shared folder). Returns ``spark.table(name)``."""
    _check(name)
    location = location or shared_path(spark, "staged", name)
    if df is not None:
        df.write.format("parquet").mode("errorifexists").option("path", location).saveAsTable(name)
    else:
        if schema is None:
            raise ValueError("stage_table needs a schema or a DataFrame")
        spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet LOCATION '{location}'")
    return spark.table(name)


def stage_like(spark: SparkSession, name: str, like: str, location: str | None = None) -> DataFrame:
    """``CREATE TABLE name LIKE other`` (schema only, no rows)."""
    _check(name)
    _check(like)
    location = location or shared_path(spark, "staged", name)
    spark.sql(f"CREATE TABLE {name} LIKE {like} USING parquet LOCATION '{location}'")
    return spark.table(name)


def insert_into(df: DataFrame, name: str, overwrite: bool = False) -> DataFrame:
    """``INSERT INTO name SELECT ...`` -- positional, like SQL: the i-th column of
    ``df`` goes to the i-th column of the table, whatever its name."""
    _check(name)
    target = df.sparkSession.table(name)
    if len(df.columns) != len(target.columns):
        raise ValueError(f"insert into {name}: {len(df.columns)} columns for {len(target.columns)}")
    df.write.insertInto(name, overwrite=overwrite)
    return df.sparkSession.table(name)
