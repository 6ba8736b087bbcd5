import pytest
from pyspark.sql import types as T

from scrubline.operators import cleaning as C
from scrubline.session import shared_path
from scrubline.sources.tables import insert_into, read_table, stage_like, stage_table

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])


def test_declared_table_like_and_positional_insert(spark):
    stage_table(spark, "t_declared", schema=SCHEMA)
    assert spark.table("t_declared").count() == 0
    assert spark.table("t_declared").schema.fieldNames() == ["a", "b"]
    stage_like(spark, "t_like", like="t_declared")
    assert [(f.name, f.dataType) for f in spark.table("t_like").schema] == \
        [(f.name, f.dataType) for f in SCHEMA]
    # Positional: column names of the source do not matter, order does.
    src = spark.createDataFrame([("x", 1), ("y", 2)], "other string, name int")
    out = insert_into(src, "t_like")
    assert sorted(tuple(r) for r in out.collect()) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        insert_into(spark.createDataFrame([("x",)], "a string"), "t_like")


def test_ctas_and_read_table(spark):
    df = spark.createDataFrame([("x", 1)], SCHEMA)
    stage_table(spark, "t_ctas", df=df)
    assert read_table(spark, "t_ctas").collect()[0].a == "x"
    path = shared_path(spark, "csv")
    df.write.csv(path)
    with pytest.raises(ValueError):
        read_table(spark, path, fmt="csv")
    assert read_table(spark, path, schema=SCHEMA, fmt="csv").collect()[0].b == 1


def test_bad_table_name_rejected(spark):
    with pytest.raises(ValueError):
        stage_table(spark, "x; DROP TABLE y", schema=SCHEMA)


def test_number_duplicates_requires_order(spark):
    with pytest.raises(ValueError):
        C.number_duplicates(spark.createDataFrame([("x", 1)], SCHEMA), "a")
