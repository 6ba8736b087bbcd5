"""MinHash near-duplicates by an inverted join on signature coordinates.

1. Every text becomes its set of word shingles (64-bit hashes), a signature of
   ``COORDS`` coordinates (each made of ``WIDTH`` minima, so that texts which only
   share a frequent shingle rarely agree) and a bitmap of the set. Documents with
   equal sets collapse to one representative, so exact copies cost nothing further.
2. Representatives are posted under every (coordinate, value) pair, as (key, id).
   Lists of one are dropped, and a document's remaining keys are put in order, the
   rarest first. Documents that agree in ``MATCHES`` keys must share one before the
   last ``MATCHES - 1`` of both (prefix), so every document's longest lists are
   skipped until a pair is a candidate; then its collisions are counted.
3. Candidates at or above the match threshold are confirmed on full sets, and
   components are built from the confirmed links.

No posting list is ever expanded into all its pairs. Star rounds compare a
list's members with one hub of the list; afterwards only pairs *between
different components* can still matter, and these are held against a bound
before they leave the join: a bitmap of the set's hashes (``BITS`` bits) shows
how many shingles of one text are certainly not in the other. Long lists
are first posted again under their members' next keys, up to paths of ``MATCHES``.
So a group of n near copies costs about n comparisons, and no pair is left out.

Only texts of confirmed candidates are hashed again, and only their sets are
shuffled: a bitmap of the candidates' ids (:class:`common.IdFilter`, of bounded size)
tells most other rows apart where they are read, at every size of the input alike.

Recall: at the threshold of 0.8 a coordinate agrees with a chance of 0.8 ** 3, so
a pair agrees in fewer than 4 of 24 with a chance of about 1e-4 (measured in the
tests), whereas a pair at 0.5 passes with 0.35 and one at 0.4 with 0.07. 64-bit
hashes stand for shingles in all comparisons.

Defined cases: null or empty texts (no word) have an empty set and link with
nothing; a text shorter than a shingle is one shingle. Rows with a null id keep
a null component and are kept. Rows that repeat an id are one document: the row
with the smallest set (by size, then hash) counts, and one row is returned. Extra
columns are ignored by :func:`components`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, fresh, stage
from .components import connected

COORDS = 24
WIDTH = 3
MATCHES = 4
STAR_ROUNDS = 2
#: A posting list with more members than this is posted again under further keys.
LONG_LIST = 4096
BITS = 1024
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def _randoms(n: int, seed: int) -> np.ndarray:
    return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _C1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of consecutive UTF-8 texts, and each word's text.

    Text i is ``data[offsets[i]:offsets[i + 1]]``; words are runs of bytes other
    than U+0020 and U+0009..U+000D, with A-Z lowered. A word's hash is a sum of
    per-byte random values times powers of an odd number, scrambled."""
    value = _randoms(256, 1)
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    lo, hi = int(offsets[0]), int(offsets[-1])
    word = np.zeros(hi - lo + 2, bool)
    word[1:-1] = ~space[data[lo:hi]]
    cuts = np.unique(offsets[1:-1]) - lo  # a text's end also ends a word
    start = word[1:-1] & ~word[:-2]
    start[cuts[cuts < hi - lo]] = word[1:-1][cuts[cuts < hi - lo]]
    end = word[1:-1] & ~word[2:]
    inner = cuts[(cuts > 0)] - 1
    end[inner] = word[1:-1][inner]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    out = np.empty(len(starts), np.uint64)
    power = np.ones(1, np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK)))
            s, n = starts[at:to], ends[at:to] - starts[at:to]
            if n.max() > len(power):
                power = np.cumprod(np.full(int(n.max()) * 2, _C1 | np.uint64(1)))
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            rel = np.arange(int(n.sum())) - np.repeat(first, n)
            byte = data[lo + np.repeat(s, n) + rel]
            out[at:to] = _mix(np.add.reduceat(value[byte] * power[rel], first)
                              ^ n.astype(np.uint64))
            at = to
    return out, np.searchsorted(offsets, starts + lo, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` words."""
    words, of = word_hashes(data, offsets)
    n_texts = len(offsets) - 1
    count = np.bincount(of, minlength=n_texts)
    bound = np.concatenate([[0], np.cumsum(count)])
    with np.errstate(over="ignore"):
        fold = words.copy()
        for k in range(1, size):
            fold = _mix(fold[:-1] * _C1 + words[k:]) if len(fold) > 1 else fold[:0]
        out = []
        for i in range(n_texts):
            a, b = int(bound[i]), int(bound[i + 1])
            if b - a >= size:
                h = np.sort(fold[a:b - size + 1])
                keep = np.ones(len(h), bool)
                keep[1:] = h[1:] != h[:-1]
                out.append(h[keep])
            elif b > a:  # fewer words than a shingle: the whole sequence is one
                x = words[a:a + 1]
                for k in range(a + 1, b):
                    x = _mix(x * _C1 + words[k:k + 1])
                out.append(_mix(x ^ np.uint64(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def signature(h: np.ndarray) -> np.ndarray:
    """COORDS coordinates of a set: each scrambles the minima of WIDTH hash
    functions into 32 bits."""
    n = COORDS * WIDTH
    xor, mul = _randoms(n, 2), _randoms(n, 3) | np.uint64(1)
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 1024):
            part = h[at:at + 1024, None] ^ xor
            part *= mul
            low = np.minimum(low, part.min(axis=0))
        out = low[:COORDS]
        for k in range(1, WIDTH):
            out = _mix(out * _C1 + low[k * COORDS:(k + 1) * COORDS])
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of a string column, hashed in blocks of about BLOCK bytes."""
    arr = column.cast(pa.large_binary()).fill_null(b"")
    _, off, buf = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK)) - 1)
        to = min(to, len(arr))
        for i, h in enumerate(shingle_sets(data, offsets[at:to + 1], size)):
            yield at + i, h
        at = to


SIG_SCHEMA = ("doc_id long, n_shingles long, f1 long, f2 long, sig array<int>, "
              "bits array<long>")


def bitmap(h: np.ndarray) -> np.ndarray:
    """One bit per hash value's top bits."""
    seen = np.zeros(BITS, np.uint8)
    seen[h >> np.uint64(64 - BITS.bit_length() + 1)] = 1
    return np.packbits(seen).view(np.int64)


def _lists(rows: list[np.ndarray], width: int, kind) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.empty(0, kind)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), pa.array(flat))


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2, sig, bits = [], [], [], [], []
            with np.errstate(over="ignore"):
                for _, h in _sets(batch.column(1), size):
                    n.append(len(h))
                    f1.append(int(_mix(h ^ _C2).sum(dtype=np.uint64).astype(np.int64)))
                    f2.append(int(_mix(h ^ _C3).sum(dtype=np.uint64).astype(np.int64)))
                    sig.append(signature(h))
                    bits.append(bitmap(h))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()),
                 pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 _lists(sig, COORDS, np.int32), _lists(bits, BITS // 64, np.int64)],
                names=["doc_id", "n_shingles", "f1", "f2", "sig", "bits"])
    return run


def _full_sets(size: int, ids: IdFilter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(ids.maybe(batch.column(0)))
            for row, h in _sets(batch.column(1), size):
                with np.errstate(over="ignore"):
                    f1 = int(_mix(h ^ _C2).sum(dtype=np.uint64).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1).cast(pa.int64()), pa.array([f1], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(h)], pa.int32()),
                                              pa.array(h.view(np.int64)))],
                    names=["id", "f1", "shingles"])
    return run


class _Job:
    """The tables of one run, all staged under the shared folder."""

    def __init__(self, docs: DataFrame, size: int, num: int, den: int):
        self.docs, self.size, self.num, self.den = docs, size, num, den
        # One row per id: the smallest of its sets.
        row = F.min(F.struct("n_shingles", "f1", "f2", "sig", "bits")).alias("s")
        self.sigs = stage(docs.mapInArrow(_signed(size), SIG_SCHEMA).groupBy("doc_id").agg(row)
                          .select("doc_id", "s.*"), "minhash_sigs")
        # One representative per distinct set (a partial aggregate: copies meet
        # in the map tasks).
        reps = (self.sigs.filter("n_shingles > 0").groupBy("f1", "f2", "n_shingles")
                .agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"),
                     F.first("bits").alias("bits")))
        self.reps = stage(reps.select("id", F.col("n_shingles").alias("n"), "sig", "bits",
                                      "f1", "f2"),
                          "minhash_reps")
        # Postings (key, id) of all coordinate-value pairs; those of one document
        # only can make no collision.
        posts = self.reps.select("id", F.posexplode("sig").alias("c", "v")).select(
            F.xxhash64("c", "v").alias("key"), "id")
        shared = stage(posts.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"),
                       "minhash_shared")
        # A document's keys, the rarest first: one order for all documents. With
        # fewer than MATCHES of them it can be in no pair.
        keys = (posts.join(shared, "key").groupBy("id")
                .agg(F.array_sort(F.collect_list(F.struct("k", "key"))).alias("ks"))
                .filter(F.size("ks") >= MATCHES)
                .select("id", F.col("ks.key").alias("keys")))
        self.members = stage(self.reps.join(keys, "id").select("id", "n", "f1", "keys", "bits"),
                             "minhash_members")
        self.links = None
        self.comp = None  # (id, component) of linked representatives

    def labelled(self, *more: str) -> DataFrame:
        """Postings of the prefixes, with their component: of two documents that
        share MATCHES keys or more, the first shared one lies before the last
        MATCHES - 1 keys of both, so those (the longest lists) are skipped."""
        members = self.members
        if self.comp is None:
            members = members.withColumn("comp", F.col("id"))
        else:
            members = members.join(self.comp, "id", "left").withColumn(
                "comp", F.coalesce("component", "id"))
        return members.select("id", "n", "comp", *more, F.posexplode(
            F.slice("keys", 1, F.size("keys") - (MATCHES - 1))).alias("at", "key"))

    def alike(self, small, large):
        """Set sizes that allow the threshold at all."""
        return small * self.den >= large * self.num

    def possible(self, x, y, n, m):
        """Whether the bitmaps leave room for the threshold: every bit that only
        one side has stands for a shingle that the other lacks, and sets that
        reach num/den differ in (n + m) * (den - num) / (den + num) shingles at most."""
        differ = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                             F.lit(0), lambda s, v: s + v)
        return differ * (self.den + self.num) <= (n + m) * (self.den - self.num)

    def confirm(self, pairs: DataFrame, label: str) -> None:
        """Keep candidate pairs that reach the match threshold, compare their full
        sets and bring the components up to date."""
        def side(x):
            return self.members.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"),
                                       F.col("f1").alias(f"f{x}"), F.col("keys").alias(f"k{x}"),
                                       F.col("bits").alias(f"b{x}"))

        cand = pairs.distinct().join(side("a"), "a").join(side("b"), "b").filter(
            (F.size(F.array_intersect("ka", "kb")) >= MATCHES)
            & self.possible("ba", "bb", F.col("na"), F.col("nb"))).select(
            "a", "b", "na", "nb", "fa", "fb")
        cand = stage(cand, label + "_pairs")
        if cand.isEmpty():
            return
        ids = IdFilter(cand.select(F.explode(F.array("a", "b")).alias("id")))
        sets = stage(self.docs.select("doc_id", "text").mapInArrow(
            _full_sets(self.size, ids), "id long, f1 long, shingles array<long>"), label + "_sets")

        def full(x):  # the set that stands for an id, should the id repeat
            return sets.select(F.col("id").alias(x), F.col("f1").alias(f"f{x}"),
                               F.col("shingles").alias(f"h{x}"))

        both = F.size(F.array_intersect("ha", "hb")).cast("long")
        found = cand.join(full("a"), ["a", "fa"]).join(full("b"), ["b", "fb"]).filter(
            both * self.den >= (F.col("na") + F.col("nb") - both) * self.num).select("a", "b")
        found = stage(found, label + "_links")
        self.links = found if self.links is None else self.links.union(found)
        self.comp = connected(self.links, label + "_stars")

    def star_round(self, k: int) -> None:
        """Every member of a list against one hub; another hub order per round."""
        posts = stage(self.labelled().drop("at"), f"minhash_posts{k}")
        order = F.struct(F.lit(0).alias("o") if k == 0 else F.xxhash64(F.lit(k), "id").alias("o"),
                         F.col("id").alias("hub"), F.col("n").alias("hn"),
                         F.col("comp").alias("hc"))
        # Staged, so that the join has two plain sides and a hot list can be split.
        hubs = stage(posts.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(order).alias("h"))
            .filter("lo < hi").select("key", "h.*"), f"minhash_hubs{k}")
        pairs = posts.join(hubs, "key").filter(
            (F.col("comp") != F.col("hc"))
            & self.alike(F.least("n", "hn"), F.greatest("n", "hn")))
        self.confirm(pairs.select(F.least("id", "hub").alias("a"),
                                  F.greatest("id", "hub").alias("b")), f"minhash_star{k}")

    def opened(self, posts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(short, long): the postings of lists that hold two components or more,
        with the list's first component; ``long`` those of over LONG_LIST postings."""
        posts = stage(posts, "minhash_lists")
        heads = stage(posts.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"),
            F.count(F.lit(1)).alias("k")).filter("lo < hi").drop("hi"), "minhash_heads")
        out = posts.join(heads, "key")
        return (out.filter(F.col("k") <= LONG_LIST).drop("k"),
                out.filter(F.col("k") > LONG_LIST).drop("k", "lo"))

    def rest(self) -> None:
        """All pairs of a list that lie in different components."""
        posts = self.labelled("keys", "bits").withColumn("path", F.array("key"))
        lists, long_ = self.opened(posts)
        # A long list is posted again under each member's next keys: of two
        # documents that share MATCHES keys, the first d + 1 shared ones make a
        # path that both have. So lists get shorter until a path has MATCHES keys.
        for depth in range(1, MATCHES):
            if long_.isEmpty():
                break
            last = F.size("keys") - (MATCHES - 1 - depth)
            again = long_.select(
                "id", "n", "comp", "keys", "bits", "path", "at", F.posexplode(
                    F.slice("keys", F.col("at") + 2, F.greatest(F.lit(0), last - F.col("at") - 1))
                ).alias("step", "next"))
            again = again.withColumn("path", F.concat("path", F.array("next"))).select(
                "id", "n", "comp", "keys", "bits", (F.col("at") + 1 + F.col("step")).alias("at"),
                F.xxhash64("path").alias("key"), "path")
            short, long_ = self.opened(again)
            lists = lists.unionByName(short)
        else:
            lists = lists.unionByName(long_.join(
                long_.groupBy("key").agg(F.min("comp").alias("lo")), "key"))
        # Members of the list's first component (most of a group of copies) are
        # only the other side of a pair, so a group is not held against itself.
        lists = stage(lists, "minhash_open")
        x, y = lists.filter("comp <> lo").alias("x"), lists.alias("y")
        common = F.array_intersect("x.keys", "y.keys")
        pairs = x.join(y, (F.col("x.key") == F.col("y.key"))
                       & (F.col("x.comp") != F.col("y.comp"))
                       & ((F.col("y.comp") == F.col("y.lo")) | (F.col("x.id") < F.col("y.id")))
                       & self.alike(F.least("x.n", "y.n"), F.greatest("x.n", "y.n"))
                       & self.possible("x.bits", "y.bits", F.col("x.n"), F.col("y.n"))
                       & (F.size(common) >= MATCHES)
                       # A pair leaves one list only: that of its first shared keys.
                       & (F.slice(common, 1, F.size("x.path")) == F.col("x.path")))
        self.confirm(pairs.select(F.least("x.id", "y.id").alias("a"),
                                  F.greatest("x.id", "y.id").alias("b")), "minhash_rest")


def components(df: DataFrame, shingle_words: int = 2, threshold_pct: int = 80,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document id: doc_id, n_shingles, component_id (the smallest id
    it can reach over links, itself included) and kept (it is that id)."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = src.filter(F.col("doc_id").isNotNull())
    job = _Job(docs, shingle_words, threshold_pct, 100)
    for k in range(STAR_ROUNDS):
        job.star_round(k)
    job.rest()
    comp = job.comp if job.comp is not None else job.reps.select(
        "id", F.col("id").alias("component")).limit(0)
    reps = stage(job.reps.join(comp, "id", "left").select(
        "f1", "f2", F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id")), "minhash_found")
    out = job.sigs.select("doc_id", "n_shingles", "f1", "f2").join(
        reps, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    null_ids = src.filter(F.col("doc_id").isNull()).mapInArrow(
        _signed(shingle_words), SIG_SCHEMA).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.union(null_ids).withColumn("kept", F.coalesce(
        F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(df: DataFrame, shingle_words: int = 5, threshold_pct: int = 80,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without the near copies: one document of each group stays
    (with all its rows, should its id repeat)."""
    gone = components(df, shingle_words, threshold_pct, id_col, text_col).filter(~F.col("kept"))
    key = fresh(df, "gone")
    ids = stage(gone.select(F.col("doc_id").alias(key)).distinct(), "minhash_gone")
    return df.join(ids, df[id_col] == ids[key], "left_anti")
