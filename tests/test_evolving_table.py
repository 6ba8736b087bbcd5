"""Defaults, NOT NULL, checked changes of types, and old files under new columns."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from scrubline.session import shared_path
from scrubline.sources import EvolvingTable, Field
from scrubline.sources.evolving_table import Refused


def _table(spark, *fields):
    return EvolvingTable.create(spark, shared_path(spark, "t_evolving"), fields or [
        Field("id", "int", nullable=False), Field("Text", "string"),
        Field("n", "string", default="'7'"), Field("day", "date", default="date'2024-01-01'")])


def _rows(table, version=None):
    return sorted((tuple(r) for r in table.read(version).collect()), key=str)


def _files(table):
    return sorted((p, os.path.getmtime(p)) for p in glob.glob(
        table.root.removeprefix("file:") + "/data/**/*.parquet", recursive=True))


def test_defaults_and_not_null(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1, "a"), (2, None)], "ID int, text string")
    t.insert(df)
    day = spark.sql("select date'2024-01-01'").collect()[0][0]
    assert _rows(t) == [(1, "a", "7", day), (2, None, "7", day)]
    before = t.versions.latest()
    for bad in (df.withColumn("id", F.lit(None).cast("int")), df.select("text")):
        with pytest.raises(Refused, match="NULL in id"):
            t.insert(bad)
    with pytest.raises(Refused, match="no columns"):
        t.insert(df.withColumn("other", F.lit(1)))
    assert t.versions.latest() == before and len(_rows(t)) == 2
    t.insert(df.limit(0))
    assert len(_rows(t)) == 2
    with pytest.raises(Refused):
        _table(spark, Field("a", "int"), Field("A", "int"))
    with pytest.raises(Refused):
        _table(spark, Field("a", "int", nullable=False, default="cast(null as int)"))
    with pytest.raises(Exception):
        _table(spark, Field("a", "no_type"))


def test_old_files_are_read_under_new_columns(spark):
    t = _table(spark)
    df = spark.createDataFrame([(1, "a", "10"), (2, "b", "20")], "id int, text string, n string")
    first = t.insert(df)
    files = _files(t)
    t.modify("N", "bigint")
    t.add(Field("extra", "int", nullable=False, default="5"))
    t.set_default("extra", "6")
    t.rename("text", "label")
    t.drop("day")
    assert _files(t) == files  # nothing was rewritten
    assert _rows(t) == [(1, "a", 10, 5), (2, "b", 20, 5)]
    assert [f.dataType.simpleString() for f in t.read().schema] == ["int", "string", "bigint", "int"]
    t.insert(spark.createDataFrame([(3, "c")], "id int, label string"))
    t.add(Field("day", "string"))  # another column of an old name
    assert _rows(t) == [(1, "a", 10, 5, None), (2, "b", 20, 5, None), (3, "c", 7, 6, None)]
    assert [r[:3] for r in _rows(t, first)] == [(1, "a", "10"), (2, "b", "20")]
    assert t.read(first).columns == ["id", "Text", "n", "day"]


def test_changes_that_rows_do_not_allow_are_refused(spark):
    t = _table(spark)
    t.insert(spark.createDataFrame([(1, "12"), (2, "x"), (3, None)], "id int, text string"))
    before = t.versions.latest()
    with pytest.raises(Refused, match="1 values of text are no int, such as 'x'"):
        t.modify("text", "int")
    with pytest.raises(Refused, match="1 rows have NULL in text"):
        t.modify("text", nullable=False)
    with pytest.raises(Refused, match="no column"):
        t.rename("nothing", "x")
    with pytest.raises(Refused):
        t.rename("text", "N")
    with pytest.raises(Refused, match="would have NULL"):
        t.add(Field("must", "int", nullable=False))
    assert t.versions.latest() == before
    assert _table(spark).read().count() == 0
    t.modify("id", "string", nullable=True)
    assert [r[0] for r in _rows(t)] == ["1", "2", "3"]
