"""Property tests against brute-force Python oracles on small random tables."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scrubline.operators import analysis as A
from scrubline.operators import cleaning as C

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""]))
ROWS = st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(-5, 5)),
                          st.integers(0, 3)), min_size=0, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, o int")


def _key(r):
    return tuple((x is None, x) for x in r)


@SETTINGS
@given(rows=ROWS)
def test_dedupe_subset_is_first_in_order(spark, rows):
    got = sorted((tuple(r) for r in C.dedupe(_df(spark, rows), "k", ["o", "v"]).collect()),
                 key=_key)
    best = {}
    for k, v, o in rows:
        cand = (o, (v is not None, v))  # NULLs first in ascending order
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, v, o))
    assert got == sorted((r for _, r in best.values()), key=_key)


@SETTINGS
@given(rows=ROWS)
def test_running_total_matches_brute_force(spark, rows):
    out = A.running_total(_df(spark, rows), "o", "v", out="rt").collect()
    for r in out:
        vals = [v for _, v, o in rows if o <= r.o and v is not None]
        assert r.rt == (sum(vals) if vals else None)
    assert len(out) == len(rows)


@SETTINGS
@given(rows=ROWS)
def test_number_duplicates_is_a_permutation_per_key(spark, rows):
    out = C.number_duplicates(_df(spark, rows), "k", ["o"]).collect()
    per = defaultdict(list)
    for r in out:
        per[r.k].append((r.row_num, r.o))
    for nums in per.values():
        nums.sort()
        assert [n for n, _ in nums] == list(range(1, len(nums) + 1))
        assert [o for _, o in nums] == sorted(o for _, o in nums)
