"""Row-level cleaning operators. Each is ``DataFrame -> DataFrame`` and stays
inside Spark's native expressions; UPDATE/DELETE become projections/filters.

Shuffles: only ``dedupe``, ``number_duplicates`` and ``fill_from_peers``
move data. All three are written so that a single key holding a large share
of the rows is collapsed map-side (partial aggregation / partial group
limit), cut into range slices, or joined map-side against a bounded
broadcast -- never gathered whole into one task (see docs/SKEW.md).

Column names are matched as Spark does (without regard to case by default), and
helper columns are named so that they clash with none of the table's.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import US_DATE_FORMAT
from ..functions.names import col as _c
from ..functions.names import collated, fresh, resolve
from ..functions.dates import parse_date as _parse_date_expr
from ..functions.text import blank_to_null as _blank_expr
from ..functions.text import starts_with, strip_trailing as _strip_expr
from ..functions.text import trim_spaces


def stage_parquet(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared folder and return a scan of it
    (cuts lineage; later filters and column pruning reach the Parquet scan)."""
    from ..session import shared_path

    path = shared_path(df.sparkSession, "staged", label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order_spec(df: DataFrame, order: str | Sequence[str]) -> list[tuple[str, bool]]:
    """``["a", "-b"]`` -> [(a, ascending), (b, descending)]."""
    out = []
    for o in _cols(order):
        name, asc = (o[1:], False) if o.startswith("-") else (o, True)
        out.append((resolve(df, name)[0], asc))
    return out


def _fingerprint(keys: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a key. NULLs leave a hash as it was, so where they stand is
    hashed as well."""
    nulls = F.concat(*[F.when(_c(k).isNull(), "1").otherwise("0") for k in keys])
    return tuple(F.xxhash64(F.lit(seed), nulls, *[_c(k) for k in keys]) for seed in (1, 2))


def split_copies(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is certainly the only one, all others).

    Only fingerprints of the keys are shuffled, 16 bytes a row. Those that occur
    twice or more are joined back (broadcast by Spark where their measured size
    allows), so a wide row that has no copy stays where it was read. Two keys with
    one fingerprint are among the others, to be told apart by the keys themselves.
    """
    h1, h2 = fresh(df, "h1", "h2")
    one, two = _fingerprint(keys)
    marked = df.withColumns({h1: one, h2: two})
    shared = (df.select(one.alias(h1), two.alias(h2)).groupBy(h1, h2)
              .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return (marked.join(shared, [h1, h2], "left_anti").select(*[_c(c) for c in df.columns]),
            marked.join(shared, [h1, h2], "left_semi").select(*[_c(c) for c in df.columns]))


def dedupe(df: DataFrame, keys: str | Sequence[str] | None = None,
           order: str | Sequence[str] | None = None, wide: bool = False,
           collation: str | None = None) -> DataFrame:
    """Keep one row per key.

    * ``keys=None`` (all columns, the exact-duplicate case): ``DISTINCT``,
      planned as a hash aggregate with a partial step, so copies collapse
      map-side before the shuffle.
    * ``keys`` a subset: ``order`` is required and names the survivor (the
      first row in that order; prefix a name with ``-`` for descending). It is
      computed as ``min``/``max`` of a struct led by the order columns -- an
      aggregate, so again partial per map task, with a deterministic winner
      even on ties (the whole row breaks them). NULL keys are one group.
    * ``wide=True``, for keys such as whole texts: only 128-bit fingerprints are
      shuffled, and full rows are compared only where a fingerprint occurs twice or
      more (:func:`split_copies`). Reads ``df`` three times: for scans, or staged
      tables; rows come as from the plain form.
    * ``collation`` (off by default): text keys compare by it. The survivor is the
      first row in ``order``, then the smallest by its bytes.
    """
    keys = list(df.columns) if keys is None else resolve(df, _cols(keys))
    whole = set(keys) == set(df.columns)
    if collation is not None:
        if wide:
            raise ValueError("fingerprints compare bytes: no collation with wide=True")
        with_keys, by = collated(df, keys, collation)
        one = dedupe(with_keys, by, order if order is not None else list(df.columns))
        return one.select(*[_c(c) for c in df.columns])
    if not whole and order is None:
        raise ValueError("dedupe on a key subset needs an explicit `order` for the survivor")
    if wide:
        single, others = split_copies(df, keys)
        return single.unionByName(dedupe(others, keys, order))
    if whole:
        return df.dropDuplicates()
    spec = _order_spec(df, order)
    directions = {asc for _, asc in spec}
    if len(directions) != 1:
        # Mixed directions cannot share one struct comparison: fall back to
        # row_number() = 1. Spark plans it with a partial WindowGroupLimit
        # before the shuffle, so each map task still ships one row per key.
        return _first_by_window(df, keys, spec)
    asc = directions.pop()
    order_names = [n for n, _ in spec]
    rest = [c for c in df.columns if c not in keys and c not in order_names]
    packed = F.struct(*[_c(c) for c in order_names + rest])
    pick = F.min(packed) if asc else F.max(packed)
    won, = fresh(df, "w")
    agg = df.groupBy(*[_c(k) for k in keys]).agg(pick.alias(won))
    return agg.select(*[_c(c) if c in keys else _c(won)[c].alias(c) for c in df.columns])


def _first_by_window(df: DataFrame, keys: list[str], spec: list[tuple[str, bool]]) -> DataFrame:
    from pyspark.sql import Window

    ordering = [_c(n).asc() if a else _c(n).desc() for n, a in spec]
    ordering += [_c(c).asc() for c in df.columns if c not in keys and c not in dict(spec)]
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(*ordering)
    rn, = fresh(df, "rn")
    return df.withColumn(rn, F.row_number().over(w)).filter(_c(rn) == 1).drop(rn)


def number_duplicates(df: DataFrame, keys: str | Sequence[str] | None = None,
                      order: str | Sequence[str] | None = None,
                      out: str = "row_num", wide: bool = False,
                      collation: str | None = None) -> DataFrame:
    """Number the copies of each key 1..n (delete nothing).

    ``order`` is mandatory (a numbering without one is not reproducible);
    ties in ``order`` are broken by the remaining columns. See
    :mod:`scrubline.operators.numbering` for the skew-safe plan. ``wide`` as in
    :func:`dedupe`: rows without a copy are number 1 and are not shuffled.
    ``collation``: text keys compare by it."""
    from .numbering import key_row_number

    keys = resolve(df, _cols(keys)) if keys is not None else list(df.columns)
    if order is None:
        raise ValueError("number_duplicates needs an explicit `order`")
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {out!r} already; name another for the number")
    if collation is not None:
        if wide:
            raise ValueError("fingerprints compare bytes: no collation with wide=True")
        with_keys, by = collated(df, keys, collation)
        return key_row_number(with_keys, by, _order_spec(df, order), out).select(
            *[_c(c) for c in df.columns], _c(out))
    if wide:
        single, others = split_copies(df, keys)
        return single.withColumn(out, F.lit(1)).unionByName(
            key_row_number(others, keys, _order_spec(df, order), out))
    return key_row_number(df, keys, _order_spec(df, order), out)


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """``DELETE FROM t WHERE p``: drop rows where ``p`` is TRUE; rows where it
    is FALSE or UNKNOWN (NULL) stay, as in SQL."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    columns = _null_columns(df, p)
    if columns:  # the same in a form that reaches the scan (IS NULL of a condition does not)
        return df.filter(reduce(lambda a, c: a | _c(c).isNull(), columns, ~p))
    return df.filter(~p | p.isNull())


#: Comparisons that are NULL just where one of their columns is (Catalyst's names).
_STRICT = {"EqualTo", "LessThan", "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual", "Not",
           "In", "StartsWith", "EndsWith", "Contains", "Like"}


def _null_columns(df: DataFrame, p: Column) -> list[str]:
    """The columns of ``df`` whose being NULL makes the one comparison ``p`` NULL;
    empty if ``p`` is anything else."""
    plan = getattr(df.filter(p), "_jdf", None)
    if plan is None:  # no plan to look at (Spark Connect)
        return []
    names: list[str] = []
    todo = [plan.queryExecution().analyzed().expressions().head()]
    while todo:
        e = todo.pop()
        kind = e.getClass().getSimpleName()
        if kind == "AttributeReference":
            names.append(e.name())
        elif kind == "Literal":
            if e.value() is None:
                return []
        elif kind in _STRICT:
            kids = e.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        else:
            return []
    return names if set(names) <= set(df.columns) else []


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows whose listed columns are all NULL (``IS NULL``; a float NaN
    is a value and is kept)."""
    keep = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    return df.filter(keep)


def update_where(df: DataFrame, col: str, value: Column | object,
                 where: Column | str | None = None) -> DataFrame:
    """``UPDATE t SET col = value [WHERE p]``. Rows where ``p`` is FALSE or
    UNKNOWN keep their value. Column order is unchanged."""
    v = value if isinstance(value, Column) else F.lit(value)
    known = {c.lower() for c in df.columns}
    if col.lower() in known:
        col, = resolve(df, col)
        if where is not None:
            p = F.expr(where) if isinstance(where, str) else where
            v = F.when(p, v).otherwise(_c(col))
        return df.withColumn(col, v.cast(df.schema[col].dataType))
    if where is not None:
        raise ValueError(f"no column {col!r} to update")
    return df.withColumn(col, v)


def trim(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """``UPDATE t SET c = TRIM(c)`` for each column."""
    return df.withColumns({c: trim_spaces(c) for c in _cols(cols)})


def canonicalize_prefix(df: DataFrame, col: str, prefix: str, value: str | None = None,
                        collation: str | None = None) -> DataFrame:
    """``SET col = value WHERE col LIKE 'prefix%'`` (value defaults to the prefix).
    The prefix is literal text: ``%``/``_`` in it are not wildcards."""
    return update_where(df, col, F.lit(prefix if value is None else value),
                        starts_with(col, prefix, collation))


def strip_trailing(df: DataFrame, col: str, remove: str = ".",
                   where_prefix: str | None = None, collation: str | None = None) -> DataFrame:
    """``SET col = TRIM(TRAILING remove FROM col) [WHERE col LIKE 'p%']``."""
    where = starts_with(col, where_prefix, collation) if where_prefix is not None else None
    return update_where(df, col, _strip_expr(col, remove), where)


def parse_date(df: DataFrame, col: str, fmt: str = US_DATE_FORMAT,
               strict: bool = False) -> DataFrame:
    """Text column -> DATE in place (``STR_TO_DATE`` + ``MODIFY COLUMN ... DATE``).
    Bad or impossible dates become NULL unless ``strict``."""
    return df.withColumn(col, _parse_date_expr(col, fmt, strict))


def retype(df: DataFrame, col: str, dtype: str, safe: bool = True) -> DataFrame:
    """``ALTER TABLE ... MODIFY COLUMN col TYPE``; ``safe`` maps failures to NULL."""
    c = F.col(col)
    return df.withColumn(col, c.try_cast(dtype) if safe else c.cast(dtype))


def blank_to_null(df: DataFrame, cols: str | Sequence[str], blank: str = "") -> DataFrame:
    """``SET c = NULL WHERE c = ''``."""
    return df.withColumns({c: _blank_expr(c, blank) for c in _cols(cols)})


def fill_from_peers(df: DataFrame, key: str, cols: str | Sequence[str],
                    stage: bool = False, skew_guard: bool = True,
                    collation: str | None = None) -> DataFrame:
    """Fill NULLs in ``cols`` from other rows with the same ``key``.

    The donor for a key is ``min`` of its non-NULL values (deterministic where
    a self-join UPDATE would pick any). A NULL key matches nothing; ``''`` is
    an ordinary key. Non-NULL values never change.

    Plan: donors are aggregated to one row per key (partial aggregation), and
    only the rows that actually need a value -- NULL in some column, key
    present -- are joined to them; all other rows pass through without a
    shuffle. AQE picks broadcast vs. sort-merge from the donors' real size.

    Hot keys (``skew_guard``): a key holding a large share of the rows to fill
    would make one join task hold all of them (AQE's skew split does not apply:
    the donor side arrives pre-partitioned by its aggregate). A mergeable sketch
    of the most frequent keys names at most 4 x partitions of them, and among
    these every key that holds more than 1/(4 x partitions) of the rows. Their
    donors, at most as many rows, are broadcast, so rows with hot keys are filled where they
    were read; the rest take the normal join. The sketch is part of the plan: no
    job runs before the result is asked for.

    The input is read several ways (kept rows, rows to fill, donors). When it
    is an expensive plan (joins, shuffles), pass ``stage=True`` to write it
    once as Parquet under the shared folder and read that instead; filters
    are otherwise pushed into each branch and the work is repeated.

    ``collation``: a text key matches by it (without the guard for hot keys, whose
    sketch compares bytes).
    """
    key, = resolve(df, key)
    cols = resolve(df, _cols(cols))
    if collation is not None:
        with_key, (by,) = collated(df, [key], collation)
        return fill_from_peers(with_key, by, cols, stage, False).select(
            *[_c(c) for c in df.columns])
    if stage:
        df = stage_parquet(df, "fill_input")
    needs = _c(key).isNotNull() & reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])
    at, given, hot = fresh(df, "at", "given", "hot")
    donors = (df.filter(_c(key).isNotNull())
                .groupBy(_c(key).alias(at))
                .agg(F.struct(*[F.min(_c(c)).alias(c) for c in cols]).alias(given)))
    needing = df.filter(needs)

    def filled(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.coalesce(_c(c), _c(given)[c]).alias(c) if c in cols else _c(c)
                             for c in df.columns])

    kept = df.filter(~needs)
    if not (skew_guard and isinstance(df.schema[key].dataType, _SKETCHED)):
        return kept.unionByName(filled(needing.join(donors, _c(key) == _c(at), "left")))
    frequent = _frequent_keys(needing, key, at)
    # At most as many rows as the sketch names.
    theirs = donors.join(F.broadcast(frequent), at).withColumn(hot, F.lit(True))
    marked = needing.join(F.broadcast(theirs), _c(key) == _c(at), "left")
    here = filled(marked.filter(_c(hot)))
    cold = marked.filter(_c(hot).isNull()).select(*[_c(c) for c in df.columns])
    return (kept.unionByName(here)
            .unionByName(filled(cold.join(donors, _c(key) == _c(at), "left"))))


#: Key types that the sketch of frequent items takes.
_SKETCHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
             T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.StringType)


def _frequent_keys(df: DataFrame, key: str, out: str, per_partition: int = 4) -> DataFrame:
    """At most ``limit = per_partition x partitions`` keys, among them every key
    that holds more than 1/limit of the rows. The sketch (one per task, merged)
    tracks eight times as many, which keeps its counts within 1/(4 x limit)."""
    from .numbering import slice_count

    limit = per_partition * slice_count(df)
    top = F.expr(f"approx_top_k({_quoted(key)}, {limit}, {8 * limit})")
    return df.agg(top.alias("top")).select(F.explode("top.item").alias(out))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
