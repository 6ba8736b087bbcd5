"""A table whose columns change without its files: DEFAULT, NOT NULL, and MODIFY
COLUMN that is checked first.

Each insert writes files under the columns of its time; a version of the table
(:class:`scrubline.sources.versions.Versions`) lists the columns and which files have
which. Readers bring old files to the present columns: a column has an id for life, so
it can be renamed, widened or narrowed, dropped or added, and no file is rewritten.

* ``insert``: columns that are not given get their default (a SQL expression), else
  NULL; a NULL in a NOT NULL column fails the insert before anything is visible.
* ``modify``: a new type is tried on all rows (one pass over that column); the first
  that does not convert, or a NULL where NOT NULL is wanted, refuses the change.
* ``add``: old rows have the new column's default, as it was when it was added.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from .versions import Versions


@dataclass(frozen=True)
class Field:
    """A column as declared: its SQL type, whether NULL is allowed, its default."""

    name: str
    type: str
    nullable: bool = True
    default: str | None = None


class Refused(ValueError):
    """Rows that the declaration does not allow."""


class EvolvingTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = Versions(spark, self.root)
        if not self.versions.latest()[0]:
            raise ValueError(f"{root} holds no table")

    @classmethod
    def create(cls, spark: SparkSession, root: str, fields: Sequence[Field]) -> EvolvingTable:
        columns = [{"id": i, "since": None, **asdict(f)} for i, f in enumerate(fields)]
        _check(spark, columns)
        Versions(spark, root).commit(1, {"columns": columns, "next": len(columns), "files": []})
        return cls(spark, root)

    # --- reading ---------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows under the present columns (or those of an earlier version)."""
        doc = self.versions.latest()[1] if version is None else self.versions.read(version)
        return self._rows(doc, doc["columns"])

    def _rows(self, doc: dict, columns: list[dict]) -> DataFrame:
        groups: dict[str, tuple[dict, list[str]]] = {}
        for f in doc["files"]:  # files of one layout are one scan
            key = json.dumps(f["layout"], sort_keys=True)
            groups.setdefault(key, (f["layout"], []))[1].append(f"{self.root}/{f['path']}")
        out = None
        for layout, paths in groups.values():
            schema = T.StructType([T.StructField(f"c{i}", _type(self.spark, t))
                                   for i, t in layout.items()])
            rows = self.spark.read.schema(schema).parquet(*paths).select(
                *[self._column(c, layout).alias(c["name"]) for c in columns])
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            out = self.spark.createDataFrame([], T.StructType(
                [T.StructField(c["name"], _type(self.spark, c["type"])) for c in columns]))
        return out

    @staticmethod
    def _column(c: dict, layout: dict) -> Column:
        if str(c["id"]) in layout:
            return col(f"c{c['id']}").cast(c["type"])
        # Added after these files: the default of that time.
        return (F.lit(None) if c["since"] is None else F.expr(c["since"])).cast(c["type"])

    # --- writing ---------------------------------------------------------------

    def insert(self, df: DataFrame) -> int:
        """Add rows (columns by name); returns the version that has them."""
        number, doc = self.versions.latest()
        known = {c["name"].lower(): c for c in doc["columns"]}
        given = {n.lower(): n for n in df.columns}
        if unknown := sorted(set(given) - set(known)):
            raise Refused(f"no columns {unknown}")
        cells = {}
        for name, c in known.items():
            value = (col(given[name]) if name in given else
                     F.lit(None) if c["default"] is None else F.expr(c["default"]))
            cells[f"c{c['id']}"] = value.cast(c["type"])
        seen = Observation(f"insert_{uuid.uuid4().hex[:8]}")
        strict = [c for c in doc["columns"] if not c["nullable"]]
        rows = df.select(*[v.alias(n) for n, v in cells.items()]).observe(
            seen, F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"c{c['id']}").isNull()).alias(f"null{c['id']}") for c in strict])
        path = f"data/{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").parquet(f"{self.root}/{path}")
        for c in strict:
            if n := seen.get[f"null{c['id']}"]:
                raise Refused(f"{n} rows have NULL in {c['name']}; nothing was inserted")
        layout = {str(c["id"]): c["type"] for c in doc["columns"]}

        def add(now):
            if now["columns"] != doc["columns"]:
                raise Refused("the columns changed meanwhile; insert again")
            return {**now, "files": [*now["files"], {"path": path, "layout": layout}]}

        return self.versions.change(add)[0]

    # --- changes of columns ----------------------------------------------------

    def _change(self, step) -> int:
        """``step(document) -> columns``, on what is the latest."""
        def apply(doc):
            columns = step(doc)
            _check(self.spark, columns)
            return {**doc, "columns": columns, "next": max(
                doc["next"], 1 + max((c["id"] for c in columns), default=-1))}

        return self.versions.change(apply)[0]

    def _named(self, doc: dict, name: str) -> dict:
        for c in doc["columns"]:
            if c["name"].lower() == name.lower():
                return c
        raise Refused(f"no column {name!r}")

    def modify(self, name: str, type: str | None = None, nullable: bool | None = None) -> int:
        """``MODIFY COLUMN``: another type, NULL allowed or not, after a look at all rows."""
        def step(doc):
            old = self._named(doc, name)
            new = {**old, "type": type or old["type"],
                   "nullable": old["nullable"] if nullable is None else nullable}
            rows = self._rows(doc, [old])
            value = col(old["name"])
            bad = value.isNotNull() & value.try_cast(new["type"]).isNull()
            found = rows.agg(F.count_if(bad).alias("bad"),
                             F.min(F.when(bad, value.cast("string"))).alias("one"),
                             F.count_if(value.isNull()).alias("nulls")).collect()[0]
            if found.bad:
                raise Refused(f"{found.bad} values of {name} are no {new['type']}, "
                              f"such as {found.one!r}")
            if found.nulls and not new["nullable"]:
                raise Refused(f"{found.nulls} rows have NULL in {name}")
            return [new if c["id"] == old["id"] else c for c in doc["columns"]]

        return self._change(step)

    def add(self, field: Field) -> int:
        """``ADD COLUMN``: rows that are there already have its default."""
        def step(doc):
            if not field.nullable and field.default is None and doc["files"]:
                raise Refused(f"rows that are there would have NULL in {field.name}")
            return [*doc["columns"], {"id": doc["next"], "since": field.default, **asdict(field)}]

        return self._change(step)

    def rename(self, old: str, new: str) -> int:
        def step(doc):
            c = self._named(doc, old)
            return [{**x, "name": new} if x["id"] == c["id"] else x for x in doc["columns"]]

        return self._change(step)

    def drop(self, name: str) -> int:
        """``DROP COLUMN``; a later column of that name is another one."""
        def step(doc):
            c = self._named(doc, name)
            return [x for x in doc["columns"] if x["id"] != c["id"]]

        return self._change(step)

    def set_default(self, name: str, default: str | None) -> int:
        """For inserts from now on."""
        def step(doc):
            c = self._named(doc, name)
            return [{**x, "default": default} if x["id"] == c["id"] else x
                    for x in doc["columns"]]

        return self._change(step)


def _type(spark: SparkSession, ddl: str) -> T.DataType:
    return T._parse_datatype_string(ddl)


def _check(spark: SparkSession, columns: list[dict]) -> None:
    names = [c["name"].lower() for c in columns]
    if not names or len(set(names)) < len(names):
        raise Refused("a table needs columns of different names")
    for c in columns:  # types and defaults must mean something
        _type(spark, c["type"])
        if c["default"] is not None:
            value = spark.range(1).select(F.expr(c["default"]).cast(c["type"])).collect()[0][0]
            if value is None and not c["nullable"]:
                raise Refused(f"the default of {c['name']} is NULL")
