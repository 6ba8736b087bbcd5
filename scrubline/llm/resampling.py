"""Target-distribution importance resampling with an exact distributed draw.

1. Features are runs of one and two words, hashed into ``BUCKETS`` buckets
   (CRC-32). Every task counts its buckets into one array; the arrays of all
   documents and of the target texts add up to two arrays of fixed size.
2. A bucket's gain compares the two distributions (smoothed by one). The gains
   are one array of ``BUCKETS`` integers, handed to the tasks; a document's
   weight is the floored mean of its features' gains.
3. A document's score is its weight plus Gumbel noise drawn from its id, so the
   highest scores are a sample without replacement. The draw is a distributed
   quickselect: random pivot keys, exact counts of the rows before, at and after
   each pivot, and the next round looks only between two neighbouring pivots
   until one of them is the k-th composite key. Only the winners are then sorted
   and ranked.

CRC-32 is linear, so all words of a block advance together, byte position by
byte position, and a word pair's value follows from the two words' states with
one table look-up per state byte.

Defined cases: a null or empty text has no words, no features and weight 0. Words
hold digits, a-z (A-Z lowered) and everything beyond ASCII. Rows are rows: those
that repeat an id are scored each on their own and may both be drawn; rows equal
in score, id and features are interchangeable. A null id draws its noise from the
seed alone and comes last among ties. Without eligible documents nothing is
drawn. Extra columns are ignored by :func:`scored` and kept by :func:`sample`.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, global_rank, let, stage

BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
DRAW_PCT = 25
#: Pivot keys per round of the quickselect.
PIVOTS = 31
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20
#: Words of up to this many bytes are hashed together, longer ones one by one.
SHORT = 64

_U = np.uint32
_ONES = _U(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & _U(1), (x >> _U(1)) ^ _U(0xEDB88320), x >> _U(1))
    return x


_TABLE = _crc_table()


def _zero_bytes(n: int) -> np.ndarray:
    """[length, state byte, value]: a state byte after ``length`` zero bytes; the
    state itself is the exclusive or of its four bytes' entries."""
    out = np.empty((n + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * _U(8))[:, None]
    for i in range(n):
        out[i + 1] = _TABLE[out[i] & _U(255)] ^ (out[i] >> _U(8))
    return out


_SHIFT = _zero_bytes(SHORT).reshape(-1)


def _advance(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """States after ``length`` (at most SHORT) zero bytes."""
    at = length * 1024
    return (_SHIFT[at + (state & _U(255))] ^ _SHIFT[at + 256 + ((state >> _U(8)) & _U(255))]
            ^ _SHIFT[at + 512 + ((state >> _U(16)) & _U(255))]
            ^ _SHIFT[at + 768 + (state >> _U(24))])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every word; text i ends at ``ends[i]``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(data))]
    first[cuts] = inside[1:-1][cuts]  # a text's end also ends a word
    last[cuts - 1] = inside[1:-1][cuts - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1 - start, np.searchsorted(ends, start, side="right")


def _word_states(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states of the words (up to SHORT bytes) from a zero state."""
    order = np.argsort(length, kind="stable")
    at, n = start[order].astype(np.int64), length[order]
    state = np.zeros(len(at), np.uint32)
    for p in range(int(n[-1]) if len(n) else 0):
        k = int(np.searchsorted(n, p, side="right"))  # words longer than p
        s = state[k:]
        state[k:] = _TABLE[(s ^ data[at[k:] + p]) & _U(255)] ^ (s >> _U(8))
    out = np.empty_like(state)
    out[order] = state
    return out


def block_features(data: np.ndarray, ends: np.ndarray, carry: int | None = None):
    """(word buckets, their text numbers, pair buckets, their text numbers, the
    last word's checksum) of lowered texts. ``carry`` is the checksum of the word
    before the block, if its first text goes on from an earlier block."""
    start, length, of = _spans(data, ends)
    if not len(start):
        none = np.empty(0, np.int64)
        return none, none, none, none, carry
    short = length <= SHORT
    clipped = np.where(short, length, 0)
    zero = _word_states(data, start, clipped)
    crc = zero ^ _advance(np.full(len(start), _ONES), clipped) ^ _ONES
    for i in np.flatnonzero(~short):
        crc[i] = zlib.crc32(data[start[i]:start[i] + length[i]])
    same = of[1:] == of[:-1]
    left, right = np.flatnonzero(same), np.flatnonzero(same) + 1
    state = crc[left] ^ _ONES
    state = _TABLE[(state ^ _U(32)) & _U(255)] ^ (state >> _U(8))
    pair = zero[right] ^ _advance(state, clipped[right]) ^ _ONES
    for i in np.flatnonzero(~short[right]):
        w = right[i]
        pair[i] = zlib.crc32(data[start[w]:start[w] + length[w]],
                             zlib.crc32(b" ", int(crc[left[i]])))
    pair_of = of[right]
    if carry is not None and of[0] == 0:
        w = data[start[0]:start[0] + length[0]].tobytes()
        pair = np.append(pair, _U(zlib.crc32(w, zlib.crc32(b" ", carry))))
        pair_of = np.append(pair_of, 0)
    tail = int(crc[-1]) if of[-1] == len(ends) - 1 else (carry if len(ends) == 1 else None)
    return crc % _U(BUCKETS), of, pair % _U(BUCKETS), pair_of, tail


def _blocks(column: pa.Array) -> Iterator[tuple]:
    """(first row, rows, features) of a string column in blocks of about BLOCK
    bytes. A longer text comes in several blocks of one row, cut between words."""
    arr = column.cast(pa.large_binary()).fill_null(b"")
    _, off, buf = arr.buffers()
    ends = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
    row = 0
    while row < len(arr):
        to = max(row + 1, int(np.searchsorted(ends, ends[row] + BLOCK, side="right")) - 1)
        lo, hi = int(ends[row]), int(ends[to])
        if hi - lo <= BLOCK:
            yield row, to - row, block_features(_LOWER[data[lo:hi]], ends[row + 1:to + 1] - lo)
        else:
            carry = None
            while lo < hi:
                end = min(lo + BLOCK, hi)
                while end < hi and _IN_WORD[_LOWER[data[end]]]:  # a word is not cut
                    gap = np.flatnonzero(~_IN_WORD[_LOWER[data[end:end + BLOCK]]])
                    end = min(hi, end + (int(gap[0]) if len(gap) else BLOCK))
                found = block_features(_LOWER[data[lo:end]], np.array([end - lo]), carry)
                yield row, 1, found
                carry, lo = found[4], end
        row = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, (words, _, pairs, _, _) in _blocks(batch.column(0)):
            total += np.bincount(words, minlength=BUCKETS)
            total += np.bincount(pairs, minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()),
                                      "n": pa.array(total[used], pa.int64())})


def bucket_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features per bucket over all texts: an array of BUCKETS counts."""
    rows = (df.select(F.col(text_col)).mapInArrow(_count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket how much likelier it is in the target, in thousandths of a nat."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log(((float(t) + 1) * s_all) / ((float(s) + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gain: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.frombuffer(gain, np.int64).astype(np.float64)  # sums stay below 2**53
        for batch in batches:
            n = batch.num_rows
            words, feats, total = (np.zeros(n, np.int64) for _ in range(3))
            for row, rows, (w, w_of, p, p_of, _) in _blocks(batch.column(1)):
                to = slice(row, row + rows)
                n_words = np.bincount(w_of, minlength=rows)
                words[to] += n_words
                feats[to] += n_words + np.bincount(p_of, minlength=rows)
                total[to] += (np.bincount(w_of, weights=value[w], minlength=rows)
                              + np.bincount(p_of, weights=value[p], minlength=rows)).astype(np.int64)
            weight = np.where(feats > 0, total // np.maximum(feats, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(feats), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id in thousandths, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(_weigh(gain.tobytes()),
                         "doc_id long, n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _key(names: list[str]) -> Column:
    return F.struct(*[F.col(n) for n in names])


def _literal(types: dict, names: list[str], values) -> Column:
    return F.struct(*[F.lit(v).cast(types[n]).alias(n) for n, v in zip(names, values)])


def kth_key(df: DataFrame, names: list[str], k: int, pivots: int = PIVOTS) -> tuple:
    """The k-th smallest composite key (from 1; the columns ``names``, non-null,
    in that order), exactly: a distributed quickselect that leaves the rows where
    they are. Needs 1 <= k <= rows. The driver sees ``pivots`` keys a round."""
    rest, before, level = df.select(*names), 0, 0
    types = {n: rest.schema[n].dataType for n in names}
    while True:
        level += 1
        pick = F.xxhash64(F.lit(level), *[F.col(n) for n in names])
        chosen = sorted({tuple(r) for r in rest.orderBy(pick).limit(pivots).collect()})
        marks = [_literal(types, names, p) for p in chosen]
        key = _key(names)
        # Three-way: a row lies between two pivots or is equal to one.
        spot = let(F.array(*marks), lambda ps: let(key, lambda x: F.struct(
            F.size(F.filter(ps, lambda p: p < x)).alias("at"),
            F.array_contains(ps, x).alias("same"))))
        found = {(r["at"], r["same"]): r["n"] for r in rest.groupBy(spot.alias("s")).agg(
            F.count(F.lit(1)).alias("n")).select("s.*", "n").collect()}
        low, high, below = None, None, 0
        for i, p in enumerate(chosen):
            less = below + found.get((i, False), 0)
            same = found.get((i, True), 0)
            if before + less >= k:
                high = i
                break
            if before + less + same >= k:
                return p
            low, below = i, less + same
        if low is not None:
            before += below
            rest = rest.filter(key > marks[low])
        if high is not None:
            rest = rest.filter(key < marks[high])
        # About 1 / pivots of the rows are left for the next round.
        rest = stage(rest, "resampling_rest")


def draw(rows: DataFrame, min_words: int = MIN_WORDS, pct: int = DRAW_PCT) -> DataFrame:
    """``rank`` (from 1, best first; null: not drawn) for the rows of :func:`scored`:
    of those with at least ``min_words`` words the best ``pct`` per cent are drawn."""
    rows = stage(rows, "resampling_scored")
    eligible = F.col("n_words") >= min_words
    k = rows.filter(eligible).count() * pct // 100
    if not k:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    keyed = rows.select("*", (-F.col("score")).alias("k1"),
                        F.col("doc_id").isNull().cast("int").alias("k2"),
                        F.coalesce("doc_id", F.lit(0)).alias("k3"), F.col("n_features").alias("k4"))
    names = ["k1", "k2", "k3", "k4"]
    last = kth_key(keyed.filter(eligible), names, k)
    types = {n: keyed.schema[n].dataType for n in names}
    wins = eligible & (_key(names) <= _literal(types, names, last))
    ranked = global_rank(keyed.filter(wins), names, "rank", "resampling_winners")
    # Rows equal to the k-th key in all of it may be more than are to be drawn.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return ranked.union(keyed.filter(~F.coalesce(wins, F.lit(False))).withColumn(
        "rank", F.lit(None).cast("long"))).drop(*names)


def sample(docs: DataFrame, target: DataFrame, pct: int = DRAW_PCT, seed: int = SEED,
           min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is drawn, all columns kept."""
    won = draw(scored(docs, target, seed, id_col, text_col), min_words, pct).filter(
        F.col("rank").isNotNull())
    key = fresh(docs, "drawn")
    ids = won.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(ids, docs[id_col].cast("long").eqNullSafe(ids[key]), "left_semi")
