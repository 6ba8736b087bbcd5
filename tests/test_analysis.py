import random
from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import raw_df
from scrubline.operators import analysis as A
from scrubline.plans import clean, explore


def collect(df, *cols):
    return [tuple(r[c] for c in (cols or df.columns)) for r in df.collect()]


def test_exploration_on_fixture(spark):
    q = explore(clean(raw_df(spark)))
    full = collect(q["full_layoffs"], "company", "percentage_laid_off", "funds_raised_millions")
    assert full == [("Coinly", "1", 5), ("Coinly", "1.0", None)]
    assert collect(q["total_by_company"]) == [("Acme", 220), ("Coinly", 30), (None, 17),
                                              ("Solo", None)]
    assert collect(q["date_span"]) == [(date(2021, 7, 1), date(2023, 3, 6))]
    assert collect(q["rolling_total"]) == [("2021-07", 9, 9), ("2022-01", 30, 39),
                                           ("2022-11", None, 39), ("2022-12", 20, 59),
                                           ("2023-03", 200, 259)]
    top = sorted(collect(q["top_companies_per_year"]), key=lambda r: (r[1], r[3]))
    assert top == [(None, 2021, 9, 1), ("Coinly", 2022, 30, 1), ("Acme", 2022, 20, 2),
                   ("Acme", 2023, 200, 1)]
    assert collect(q["total_by_year"])[-1] == (None, 8)


def test_text_equals_numeric_meaning_no_ansi_error(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("0.5",), ("",), ("abc",), (None,), ("1abc",)],
                               "p string")
    assert [r.p for r in A.numeric_text_equals(df, "p", 1).collect()] == ["1", "1.0"]


def test_total_by_sorts_null_last(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 5)], "k string, m int")
    assert collect(A.total_by(df, "k", "m")) == [("c", 5), ("a", 1), ("b", None)]


def test_running_total_range_frame_matches_window(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([None] + list(range(40))),
             None if rnd.random() < 0.2 else rnd.randint(-5, 50)) for _ in range(3000)]
    data += [(-1, None), (-2, None), (100, None)]  # all-NULL keys first and last
    df = spark.createDataFrame(data, "k int, v int")
    got = sorted(collect(A.running_total(df, "k", "v", out="rt")), key=repr)
    want = sorted(collect(df.withColumn("rt", F.sum("v").over(Window.orderBy("k")))), key=repr)
    assert got == want
    last = A.running_total(df, "k", "v", out="rt").orderBy(F.col("k").desc()).first()
    assert last.rt == sum(v for _, v in data if v is not None)


def test_running_total_null_only_prefix(spark):
    df = spark.createDataFrame([(m, None if m < 4 or m == 6 else m) for m in range(1, 11)],
                               "m int, v int")
    got = [r.rt for r in A.running_total(df, "m", "v", out="rt", unique_order=True)
           .orderBy("m").collect()]
    assert got == [None, None, None, 4, 9, 9, 16, 24, 33, 43]


def test_running_total_unique_order(spark):
    df = spark.createDataFrame([(m, m * 10) for m in range(1, 101)], "m int, v int")
    out = A.running_total(df, "m", "v", unique_order=True).orderBy("m").collect()
    assert [r.rolling_total for r in out][-1] == sum(m * 10 for m in range(1, 101))
    assert out[4].rolling_total == 150


def test_top_n_dense_rank_keeps_ties_and_null_group_dropped(spark):
    df = spark.createDataFrame([
        ("a", 1, 10), ("b", 1, 10), ("c", 1, 9), ("d", 1, 8), ("e", 1, None), ("f", None, 99)],
        "c string, y int, t int")
    out = sorted(collect(A.top_n_per_group(df, "y", "t", n=2)))
    assert out == [("a", 1, 10, 1), ("b", 1, 10, 1), ("c", 1, 9, 2)]
    small = sorted(collect(A.top_n_per_group(df, "y", "t", n=5)))
    assert ("e", 1, None, 4) in small  # an all-NULL total still ranks in a small group


def test_top_n_plan_has_partial_window_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    plan = A.top_n_per_group(df, "g", "v", n=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_total_by_period_month_drops_null_dates(spark):
    df = spark.createDataFrame([(date(2022, 1, 5), 1), (date(2022, 1, 9), 2), (None, 7)],
                               "d date, m int")
    assert collect(A.total_by_period(df, "d", "m", period="month", sort="asc")) == [("2022-01", 3)]
    assert sorted(collect(A.total_by_period(df, "d", "m")), key=repr) == sorted(
        [(2022, 3), (None, 7)], key=repr)


def test_running_total_with_carried_columns_and_no_exchange_reuse(spark):
    from pyspark.sql import functions as F

    from scrubline.operators.analysis import running_total

    n = 200_000
    df = spark.range(n).select("id", F.lit(1).alias("v"), F.xxhash64("id").alias("extra"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = running_total(df, "id", "v", unique_order=True)
        assert out.filter(F.col("rolling_total") != F.col("id") + 1).count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_numbering_without_exchange_reuse(spark):
    from pyspark.sql import functions as F

    from scrubline.operators.cleaning import number_duplicates

    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), "id")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = number_duplicates(df, "k", order="id")
        assert out.filter(F.col("row_num") != F.floor(F.col("id") / 3) + 1).count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
