"""Tables that hold every helper name, names in another case, wide keys by
fingerprints, hot groups, and plans."""

import collections

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from scrubline.functions.names import fresh, resolve
from scrubline.operators import analysis as A
from scrubline.operators import cleaning as C
from scrubline.session import shared_path

HELPERS = ["_pid", "_local", "_first", "_last_key", "_last_n", "_cum", "_offset", "_k", "_v", "_t",
           "_off", "_w", "_rn", "_at", "_given", "_hot", "_h1", "_h2", "_value", "_g0", "_n"]


@pytest.fixture(scope="module")
def clash(spark):
    """A table whose other columns have all helper names, in mixed case."""
    rows = [(f"k{i % 7}", i % 5 if i % 4 else None, *[i * 100 + j for j in range(len(HELPERS))])
            for i in range(200)]
    names = [n.upper() if j % 2 else n for j, n in enumerate(HELPERS)]
    return spark.createDataFrame(rows, "key string, v int, " + ", ".join(f"{n} int" for n in names))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("wide", [False, True])
def test_numbers_and_dedupe_leave_other_columns_alone(spark, clash, wide):
    got = C.number_duplicates(clash, ["KEY", "v"], order=["-_PID"], wide=wide)
    assert got.columns == [*clash.columns, "row_num"]
    assert _rows(got.drop("row_num")) == _rows(clash)
    by_key = collections.defaultdict(list)
    for r in got.collect():
        by_key[r["key"], r.v].append((-r["_pid"], r.row_num))
    assert all([n for _, n in sorted(v)] == list(range(1, len(v) + 1)) for v in by_key.values())
    for order in (["_pid"], ["-_pid"], ["v", "-_pid"]):
        kept = C.dedupe(clash, "Key", order=order, wide=wide)
        assert kept.columns == clash.columns and kept.count() == 7
        assert set(_rows(kept)) <= set(_rows(clash))
    assert {r["key"]: r["_pid"] for r in C.dedupe(clash, "key", order="_pid", wide=wide).collect()} \
        == {f"k{i}": i * 100 for i in range(7)}
    with pytest.raises(ValueError, match="already"):
        C.number_duplicates(clash, "key", order="_pid", out="_K")


@pytest.mark.parametrize("guard", [True, False])
def test_peer_fill_finds_names_in_any_case(spark, clash, guard):
    got = C.fill_from_peers(clash, "KEY", "V", skew_guard=guard)
    assert got.columns == clash.columns and got.filter("v IS NULL").count() == 0
    least = {r["key"]: r.m for r in clash.groupBy("key").agg(F.min("v").alias("m")).collect()}
    want = [tuple(least[r[0]] if i == 1 and x is None else x for i, x in enumerate(r))
            for r in clash.collect()]
    assert _rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("unique", [True, False])
def test_running_total_and_top_n_leave_other_columns_alone(spark, clash, unique):
    src = clash if not unique else clash.filter("key = 'k1'")
    got = A.running_total(src, "_PID", "V", unique_order=unique)
    assert got.columns == [*clash.columns, "rolling_total"]
    total, want = 0, []
    for r in sorted(src.collect(), key=lambda r: r["_pid"]):
        total += r.v or 0
        want.append((*r, total if total or r.v is not None else None))
    assert _rows(got) == sorted(want, key=str)
    top = A.top_n_per_group(clash, "KEY", "V", n=2)
    assert top.columns == [*clash.columns, "ranking"]
    values = collections.defaultdict(set)
    for r in clash.collect():
        values[r["key"]].add(-1 if r.v is None else r.v)
    for r in top.collect():
        ranked = sorted(values[r["key"]], reverse=True)
        assert ranked[r.ranking - 1] == r.v and r.ranking <= 2
    assert len(top.collect()) == sum((-1 if r.v is None else r.v) in sorted(
        values[r["key"]], reverse=True)[:2] for r in clash.collect())


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "_a int, `b.c` int")
    assert fresh(df, "A", "a", "b") == ["__A", "___a", "_b"]
    assert resolve(df, ["_A", "B.C"]) == ["_a", "b.c"]
    with pytest.raises(ValueError, match="no column"):
        resolve(df, "x")
    twice = C.number_duplicates(df.union(df), ["b.c"], order="_a")
    assert sorted(r.row_num for r in twice.collect()) == [1, 2]


def test_forced_fingerprint_collisions_are_told_apart(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = C.dedupe(docs, ["text", "lang"], order="doc_id")
    numbered = C.number_duplicates(docs, "text", order="doc_id")
    for hashes in (lambda keys: (F.lit(1).cast("long"), F.lit(2).cast("long")),
                   lambda keys: (F.length(keys[0]).cast("long") % 50, F.lit(2).cast("long")),
                   C._fingerprint):
        monkeypatch.setattr(C, "_fingerprint", hashes)
        assert _rows(C.dedupe(docs, ["text", "lang"], order="doc_id", wide=True)) == _rows(want)
        assert _rows(C.number_duplicates(docs, "text", order="doc_id", wide=True)) == _rows(numbered)
    odd = spark.createDataFrame([(None, "a", 0.0), ("a", None, -0.0), (None, "a", -0.0),
                                 (None, None, float("nan")), (None, None, float("nan"))],
                                "x string, y string, z double")
    assert C.dedupe(odd, wide=True).count() == 3 == C.dedupe(odd).count()
    assert C.dedupe(odd.limit(0), wide=True).count() == 0


def _exchanged(run):
    """Bytes that a query writes to shuffles, from its metrics."""
    df = run()
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            m, kids = p.metrics(), p.children()
            if m.contains("shuffleBytesWritten"):
                total += m.apply("shuffleBytesWritten").value()
            todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_wide_rows_without_a_copy_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    run = lambda wide: C.dedupe(docs, ["text", "lang", "source"], order=["doc_id"], wide=wide)
    plain = _exchanged(lambda: run(False))
    wide = _exchanged(lambda: run(True))
    assert 0 < wide * 3 < plain
    assert _rows(run(True)) == _rows(run(False))


def test_top_n_has_no_window_over_the_rows(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("hot").alias("g"), F.lit(7).alias("v"), "id")
    src = df.unionByName(spark.range(50).select(
        F.lit("cold").alias("g"), F.col("id").cast("int").alias("v"), "id"))
    for stage in (False, True):
        top = A.top_n_per_group(src, "g", "v", n=5, stage=stage)
        assert top.filter("g = 'hot'").count() == n and top.filter("g = 'cold'").count() == 5
        plan = top._jdf.queryExecution().optimizedPlan().toString()
        # What the window goes over is an aggregate (or, if staged, not in the plan).
        assert ("Window" in plan) != stage
        assert stage or "Aggregate" in plan[plan.index("Window"):]
    # The hot rows stay in the tasks that read them: no shuffle holds them.
    parts = top.filter("g = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert parts.count() > 1


def test_peer_fill_runs_no_job_while_it_is_built(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("peer-fill-build", "")
    out = C.fill_from_peers(df, "k", "v")
    assert tracker.getJobIdsForGroup("peer-fill-build") == []
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert out.filter("k = 'hot' and v is null").count() == 0
    # Hot rows are filled where they were read: as many in each task as were there.
    sizes = [r["count"] for r in out.filter("k = 'hot'").groupBy(F.spark_partition_id()).count()
             .collect()]
    assert max(sizes) <= 1.5 * 3334 / max(1, spark.sparkContext.defaultParallelism)


def test_frequent_keys_holds_every_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 < 2, F.lit("warm"))
        .otherwise(F.col("id").cast("string")).alias("k"))
    got = [r.item for r in C._frequent_keys(df, "k", "item").collect()]
    limit = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {"hot", "warm"} <= set(got) and len(got) <= limit


def test_delete_reaches_the_scan(spark):
    path = shared_path(spark, "t_delete")
    spark.createDataFrame([("R", 1), ("A", 2), (None, 3)], "f string, n int").write.parquet(path)
    df = spark.read.parquet(path)
    for p in (F.col("f") == "R", "f = 'R'", F.col("n") > 1, F.col("f").startswith("R"),
              F.col("f").isin("R", "S"), F.col("f").isNull()):
        out = C.delete_where(df, p)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan, plan
    assert sorted(r.n for r in C.delete_where(df, F.col("f") == "R").collect()) == [2, 3]
    assert sorted(r.n for r in C.delete_where(df, "n > 1 and f = 'A'").collect()) == [1, 3]
    for p in ("f = 'R' or n = 3", "f = 'R' and n = 1", "f = 'x' and n = 3", "not (f = 'R')",
              "f in ('R', null)", "f = null", "try_cast(f as int) = 1", "f is null or n = 1"):
        want = [r.n for r in df.filter(f"not coalesce({p}, false)").collect()]
        assert sorted(r.n for r in C.delete_where(df, p).collect()) == sorted(want), p
