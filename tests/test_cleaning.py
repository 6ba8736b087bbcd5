from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import raw_df
from scrubline.operators import cleaning as C
from scrubline.plans.cleaning_job import CleanSpec, clean


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_fixture_clean_expected_rows(spark):
    out = clean(raw_df(spark))
    got = rows(out, "company", "industry", "total_laid_off", "percentage_laid_off", "date", "country")
    expected = sorted([
        ("Acme", "Retail", 100, "0.5", date(2023, 3, 6), "United States"),
        ("Acme", "Retail", 100, "0.5", date(2023, 3, 6), "United States"),  # " Acme" survives (T3)
        ("Acme", "Retail", 20, None, date(2022, 12, 16), "United States"),
        ("Coinly", "Crypto", 30, "1", date(2022, 1, 2), "France."),
        ("Coinly", "Crypto", None, "1.0", date(2022, 11, 30), "France"),
        ("Solo", None, None, "0.25", None, "Norway"),
        (None, None, 8, None, None, "Peru"),
        (None, "Food", 9, "", date(2021, 7, 1), "Peru"),
    ], key=repr)
    assert got == expected
    assert out.schema["date"].dataType == T.DateType()
    assert out.columns == raw_df(spark).columns


def test_clean_without_staging_is_identical(spark):
    a = clean(raw_df(spark))
    b = clean(raw_df(spark), CleanSpec(stage_before_fill=False))
    assert rows(a) == rows(b)


def test_second_dedupe_is_opt_in(spark):
    out = clean(raw_df(spark), CleanSpec(second_dedupe=True))
    acme_100 = [r for r in out.collect() if r.company == "Acme" and r.total_laid_off == 100]
    assert len(acme_100) == 1


def test_dedupe_whole_row_collapses_exact_copies_and_null_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a")], "k int, v string")
    assert rows(C.dedupe(df)) == rows(spark.createDataFrame([(1, None), (1, "a"), (2, "a")],
                                                            "k int, v string"))


def test_dedupe_subset_keeps_first_in_order(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, 9, "z"), (None, 1, "n"),
                                (None, 2, "m")], "k int, o int, v string")
    assert rows(C.dedupe(df, "k", order="o")) == sorted(
        [(1, 3, "y"), (2, 9, "z"), (None, 1, "n")], key=repr)
    assert rows(C.dedupe(df, "k", order="-o")) == sorted(
        [(1, 5, "x"), (2, 9, "z"), (None, 2, "m")], key=repr)
    mixed = C.dedupe(df, "k", order=["o", "-v"])
    assert rows(mixed) == sorted([(1, 3, "y"), (2, 9, "z"), (None, 1, "n")], key=repr)
    with pytest.raises(ValueError):
        C.dedupe(df, "k")


def test_dedupe_idempotent_and_order_independent(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("k"), (F.col("id") % 5).alias("v"))
    once = C.dedupe(df)
    assert rows(C.dedupe(once)) == rows(once)
    assert rows(C.dedupe(df.orderBy(F.rand(7)))) == rows(once)


def test_number_duplicates_matches_window_under_skew(spark):
    # One key holds half the rows, so it spans several range slices.
    hot = spark.range(0, 6000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string"))
         .alias("k"),
        ((F.col("id") * 7919) % 6007).alias("o"), F.col("id"))
    from scrubline.operators.numbering import key_row_number

    spec = [("o", True)]
    a = key_row_number(hot, ["k"], spec, strategy="range")
    b = key_row_number(hot, ["k"], spec, strategy="window")
    assert rows(a) == rows(b)
    assert a.filter("k = 'hot'").agg(F.max("row_num")).first()[0] == 3000


def test_number_duplicates_null_keys_and_descending(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 3), ("b", 2)],
                               "k string, o int")
    out = C.number_duplicates(df, "k", order="-o")
    assert rows(out) == sorted([(None, 2, 1), (None, 1, 2), ("a", 3, 1), ("a", 1, 2),
                                ("b", 2, 1)], key=repr)


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert rows(C.delete_where(df, F.col("x") > 2)) == [(1,), (None,)]
    assert rows(C.delete_where(df, "x > 2")) == [(1,), (None,)]


def test_drop_all_null_keeps_nan_and_partial(spark):
    df = spark.createDataFrame([(None, None), (float("nan"), None), (None, 1.0), (2.0, 2.0)],
                               "a double, b double")
    assert C.drop_all_null(df, ["a", "b"]).count() == 3


def test_update_where_unknown_predicate_keeps_value(spark):
    df = spark.createDataFrame([("x", 1), ("y", None)], "s string, n int")
    out = C.update_where(df, "s", "z", F.col("n") == 1)
    assert rows(out) == [("y", None), ("z", 1)]


def test_parse_date_one_or_two_digits_and_bad_dates(spark):
    df = spark.createDataFrame([("3/6/2023",), ("01/02/2022",), ("12/16/2022",), ("2/30/2023",),
                                ("junk",), (None,)], "d string")
    out = [r.d for r in C.parse_date(df, "d").collect()]
    assert out == [date(2023, 3, 6), date(2022, 1, 2), date(2022, 12, 16), None, None, None]
    with pytest.raises(Exception):
        C.parse_date(df, "d", strict=True).collect()


def test_strip_trailing_all_dots_and_substring(spark):
    df = spark.createDataFrame([("United States...",), ("France.",), ("a.b.",)], "c string")
    out = [r.c for r in C.strip_trailing(df, "c", ".", where_prefix="United States").collect()]
    assert out == ["United States", "France.", "a.b."]
    df2 = spark.createDataFrame([("x-.-.",), ("x.-",)], "c string")
    assert [r.c for r in C.strip_trailing(df2, "c", "-.").collect()] == ["x", "x.-"]


def test_trim_spaces_only(spark):
    df = spark.createDataFrame([("  a b  ",), ("\tb ",)], "c string")
    assert [r.c for r in C.trim(df, "c").collect()] == ["a b", "\tb"]


def test_canonicalize_prefix_literal_and_collation(spark):
    df = spark.createDataFrame([("CryptoCurrency",), ("crypto x",), ("Crypt",), ("50%_off",),
                                (None,)], "c string")
    out = [r.c for r in C.canonicalize_prefix(df, "c", "Crypto").collect()]
    assert out == ["Crypto", "crypto x", "Crypt", "50%_off", None]
    ci = [r.c for r in C.canonicalize_prefix(df, "c", "Crypto", collation="UTF8_LCASE").collect()]
    assert ci[:2] == ["Crypto", "Crypto"]
    lit = [r.c for r in C.canonicalize_prefix(df, "c", "50%", "pct").collect()]
    assert lit[3] == "pct"


def test_blank_to_null(spark):
    df = spark.createDataFrame([("",), (" ",), ("a",), (None,)], "c string")
    assert [r.c for r in C.blank_to_null(df, "c").collect()] == [None, " ", "a", None]


def test_fill_from_peers_null_key_blank_key_and_min_donor(spark):
    df = spark.createDataFrame([
        ("a", None), ("a", "z"), ("a", "b"), (None, None), (None, "q"), ("", None), ("", "e"),
        ("solo", None)], "k string, v string")
    out = rows(C.fill_from_peers(df, "k", "v"))
    assert out == sorted([("a", "b"), ("a", "z"), ("a", "b"), (None, None), (None, "q"),
                          ("", "e"), ("", "e"), ("solo", None)], key=repr)


def test_fill_from_peers_never_changes_present_values(spark):
    df = spark.range(0, 3000).select((F.col("id") % 50).alias("k"),
                                     F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id"))
                                      .alias("v"), F.col("id"))
    out = C.fill_from_peers(df, "k", "v")
    joined = df.alias("a").join(out.alias("b"), "id")
    assert joined.filter("a.v IS NOT NULL AND a.v <> b.v").count() == 0
    assert out.filter("v IS NULL").count() == 0
    assert out.count() == 3000


def test_retype(spark):
    df = spark.createDataFrame([("1",), ("x",)], "c string")
    assert [r.c for r in C.retype(df, "c", "int").collect()] == [1, None]


def test_fill_from_peers_hot_key_split_matches_plain_join(spark):
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string"))
         .alias("k"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id") % 7))
         .alias("v"),
        "id")
    from scrubline.operators.cleaning import _frequent_keys

    # 800 rows to fill: "hot" holds 400, keys 5/15/25/35 hold 100 each; all are
    # above 1/(4 x 8 partitions) of the total, no other key has a NULL.
    hot = _frequent_keys(df.filter("v IS NULL"), "k", "k").collect()
    assert sorted(r.k for r in hot) == ["15", "25", "35", "5", "hot"]
    guarded = C.fill_from_peers(df, "k", "v")
    plain = C.fill_from_peers(df, "k", "v", skew_guard=False)
    assert rows(guarded) == rows(plain)
    assert guarded.count() == 4000


def test_fill_from_peers_several_columns(spark):
    df = spark.createDataFrame([
        ("a", None, 1), ("a", "x", None), ("a", "w", 5), ("b", None, None), ("b", None, 2)],
        "k string, s string, n int")
    out = rows(C.fill_from_peers(df, "k", ["s", "n"]))
    assert out == sorted([("a", "w", 1), ("a", "x", 1), ("a", "w", 5), ("b", None, 2),
                          ("b", None, 2)], key=repr)
