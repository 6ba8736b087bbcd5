"""Hard negatives from Hilbert-ordered blocks with zone maps.

1. Vectors become integers, floor(scale * x). One pass gives every dimension's mean
   and deviation; the ``CURVE_DIMS`` dimensions of the widest spread, in
   ``CURVE_BITS`` bits each, place a row on a Hilbert curve.
2. Rows are ordered by (label, place on the curve) and packed into blocks of
   ``BLOCK_ROWS`` rows, each a row group of its own in Parquet files under the
   shared folder. A block's zone map holds the smallest and largest value of every
   dimension and of the labels.
3. Anchors, in the same order, are dealt over tasks. A task reads the zone maps a
   page at a time. Interval arithmetic bounds every inner product of an anchor with
   the rows of a block: the block is read only if it can hold a row that one of the
   task's anchors still lacks, the most promising blocks first.
4. First each anchor's best rows of its own label are found (its positives). Each
   positive's score gives a window of scores, and a second pass finds the best
   rows of other labels inside every window.

No candidate row is shuffled after it was ordered; a task holds one page of zone
maps, one block, and ``CHUNK`` anchors with their results. Tasks only read files
that are already complete, so a lost executor repeats its own tasks alone. The
shared folder has to be one that pyarrow's file systems reach.

Scores are exact integers (those beyond ``TOP`` are clipped); higher scores come
first, ties by smaller id. Defined cases: rows with a null id, label or vector or a
null or non-finite component take no part; a shorter vector counts as padded with
zeros. Rows are rows: those that repeat an id are candidates of their own, though
none is a positive of its own id; anchors that repeat in all of id, label and
vector count once. Fewer positives or negatives than asked for are all returned;
windows of a negative positive score are empty. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import file_system, stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these per cents of its positive's.
WINDOW = (30, 90)
CURVE_DIMS = 16
CURVE_BITS = 3
BLOCK_ROWS = 1024
#: Zone maps that are held against the anchors at once.
PAGE = 256
#: Anchors of a task that go through the blocks together.
CHUNK = 8192
#: Anchors whose scores against a block are held at once.
STRIP = 256
#: Scores are clipped to this, so that per cents of them fit 64 bits.
TOP = ((1 << 63) - 1) // 128
_NONE = -(1 << 62)
_LAST = (1 << 63) - 1


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows) of ``bits`` bits per
    axis, by Skilling's transform. Axes times bits must not exceed 63."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):  # undo the turns of each level
        q = np.int64(1 << level)
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(on, q - 1, swap)
            x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & np.int64(1 << level), np.int64((1 << level) - 1), 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def _padded(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a list column, rows padded with zeros."""
    column = column.cast(pa.large_list(pa.float64()))
    size = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy())
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims))
    out[np.repeat(np.arange(len(size)), size),
        np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _spread(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square, most = 0, np.zeros(0), np.zeros(0), 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.diff(batch.column(0).cast(pa.large_list(pa.float64())).offsets.to_numpy())
            x = _padded(batch.column(0), int(size.max()), scale)
            if x.shape[1] > len(total):
                total, square = (np.pad(a, (0, x.shape[1] - len(a))) for a in (total, square))
            n += len(x)
            total[:x.shape[1]] += x.sum(0)
            square[:x.shape[1]] += (x * x).sum(0)
            most = max(most, float(np.abs(x).max(initial=0.0)))
        d = len(total)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(range(-1, d), pa.int32()), "n": pa.array([n] * (d + 1), pa.int64()),
            "total": pa.array([0.0, *total]), "square": pa.array([0.0, *square]),
            "most": pa.array([most] * (d + 1))})
    return run


class Layout:
    """How the rows of a run are laid out: fitted on all of them, one figure per
    dimension."""

    def __init__(self, vectors: DataFrame, scale: int):
        got = (vectors.mapInArrow(_spread(scale), "dim int, n long, total double, square double, "
                                  "most double").groupBy("dim")
               .agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                    F.sum("square").alias("square"), F.max("most").alias("most"))
               .orderBy("dim").collect())  # one row per dimension
        self.scale, self.dims = scale, max(len(got) - 1, 0)
        n = max((r.n for r in got), default=0) or 1
        mean = np.array([r.total / n for r in got[1:]])
        dev = np.sqrt(np.maximum(np.array([r.square / n for r in got[1:]]) - mean ** 2, 0.0))
        self.axes = np.sort(np.argsort(-dev, kind="stable")[:CURVE_DIMS])
        self.low = mean[self.axes] - 2 * dev[self.axes]
        self.step = np.maximum(4 * dev[self.axes] / (1 << CURVE_BITS), 1e-9)
        most = max((r.most for r in got), default=0.0)
        self.kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"

    def place(self, x: np.ndarray) -> np.ndarray:
        if not len(self.axes):
            return np.zeros(len(x), np.int64)
        cell = np.clip(np.floor((x[:, self.axes] - self.low) / self.step), 0,
                       (1 << CURVE_BITS) - 1)
        return hilbert(cell, CURVE_BITS)


def _placed(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = layout.dims * np.dtype(layout.kind).itemsize
        for batch in batches:
            x = _padded(batch.column(2), layout.dims, layout.scale)
            raw = x.astype(layout.kind).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(layout.place(x)),
                 pa.array([raw[i * width:(i + 1) * width] for i in range(len(x))], pa.binary()),
                 batch.column(3)],
                names=["id", "label", "place", "values", "anchor"])
    return run


_BLOCK = ("n int, label_low long, label_high long, low binary, high binary, ids binary, "
          "labels binary, values binary")


def _pack(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        labels: list = []
        values: list = []

        def block(n):
            x = np.frombuffer(b"".join(values[:n]), layout.kind).reshape(n, layout.dims)
            lab = np.array(labels[:n], np.int64)
            out = {"n": [n], "label_low": [int(lab.min())], "label_high": [int(lab.max())],
                   "low": [x.min(0).tobytes()], "high": [x.max(0).tobytes()],
                   "ids": [np.array(ids[:n], np.int64).tobytes()], "labels": [lab.tobytes()],
                   "values": [x.tobytes()]}
            del ids[:n], labels[:n], values[:n]
            return pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("n", pa.int32()), ("label_low", pa.int64()), ("label_high", pa.int64())]
                + [(c, pa.binary()) for c in ("low", "high", "ids", "labels", "values")]))

        for batch in batches:
            for held, k in ((ids, 0), (labels, 1), (values, 2)):
                held += batch.column(k).to_pylist()
            while len(ids) >= BLOCK_ROWS:
                yield block(BLOCK_ROWS)
        if ids:
            yield block(len(ids))
    return run


def _write(df: DataFrame, label: str, group_rows: int) -> str:
    """Parquet files of row groups of ``group_rows`` rows, under the shared folder."""
    path = shared_path(df.sparkSession, "llm", label)
    (df.write.mode("errorifexists").option("compression", "zstd")
     .option("parquet.block.row.count.limit", str(group_rows)).parquet(path))
    return path


class Blocks:
    """The ordered blocks of a run: ``path`` of their Parquet files, ``zones`` of
    their zone maps."""

    def __init__(self, rows: DataFrame, layout: Layout):
        spark = rows.sparkSession
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["label", "place", "id"]
        self.layout = layout
        self.path = _write(rows.repartitionByRange(slices, *order).sortWithinPartitions(*order)
                           .select("id", "label", "values").mapInArrow(_pack(layout), _BLOCK),
                           "negatives_blocks", 1)
        zones = spark.read.schema(_BLOCK).parquet(self.path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
            "n", "label_low", "label_high", "low", "high")
        files = max(1, -(-zones.count() // (PAGE * 256)))
        self.zones = _write(zones.repartitionByRange(files, "label_low", "file", "row")
                            .sortWithinPartitions("label_low", "file", "row"),
                            "negatives_zones", PAGE)


# --- inside a task ------------------------------------------------------------

def _pages(path: str) -> Iterator[pa.RecordBatch]:
    """The zone maps, a page at a time."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    system, root = file_system(path)
    for f in sorted(x.path for x in system.get_file_info(fs.FileSelector(root))
                    if x.path.endswith(".parquet")):
        with system.open_input_file(f) as src:
            yield from pq.ParquetFile(src).iter_batches(PAGE)


class _Files:
    """Blocks by file and row; the files stay open while a page is gone through."""

    def __init__(self, layout: Layout):
        self.layout, self.open = layout, {}

    def block(self, file: str, row: int):
        import pyarrow.parquet as pq

        if file not in self.open:
            system, path = file_system(file)
            pf = pq.ParquetFile(system.open_input_file(path))
            rows = [pf.metadata.row_group(i).num_rows for i in range(pf.num_row_groups)]
            self.open[file] = pf, np.cumsum([0, *rows])
        pf, first = self.open[file]
        group = int(np.searchsorted(first, row, side="right")) - 1
        got = pf.read_row_group(group, columns=["n", "ids", "labels", "values"]).slice(
            row - int(first[group]), 1).to_pylist()[0]
        x = np.frombuffer(got["values"], self.layout.kind).reshape(got["n"], self.layout.dims)
        return np.frombuffer(got["ids"], np.int64), np.frombuffer(got["labels"], np.int64), x

    def close(self):
        for pf, _ in self.open.values():
            pf.close()
        self.open = {}


class Best:
    """The ``k`` best (score, id) of many slots; an empty place has score _NONE."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), _NONE, np.int64)
        self.id = np.full((slots, k), _LAST, np.int64)

    def least(self, slots=slice(None)) -> np.ndarray:
        """What a score must reach to enter (with a smaller id, if equal)."""
        return self.score[slots, self.k - 1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched, of = np.unique(slot, return_inverse=True)
        of = np.concatenate([of, np.repeat(np.arange(len(touched)), self.k)])
        score = np.concatenate([score, self.score[touched].ravel()])
        ids = np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((ids, -score, of))
        of = of[order]
        at = np.arange(len(of)) - np.searchsorted(of, np.arange(len(touched)))[of]
        keep = at < self.k
        self.score[touched[of[keep]], at[keep]] = score[order][keep]
        self.id[touched[of[keep]], at[keep]] = ids[order][keep]


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0.0)))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, in the narrowest arithmetic that is exact."""
    top = _norm(q) * _norm(x) * 1.001
    if top < 1 << 24:
        return (q.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
    if top < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    wide = [[int(v) for v in r] for r in x]
    return np.array([[min(max(sum(int(a) * b for a, b in zip(r, w)), -TOP), TOP) for w in wide]
                     for r in q], np.int64).reshape(len(q), len(x))


def interval_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(least, greatest) inner product of each query with any point of each box."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    least, greatest = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    # Whole numbers, exact unless they are huge.
    slack = _norm(q) * max(_norm(low), _norm(high))
    slack = 0.0 if slack < 1 << 52 else slack * 1e-9
    return least - slack, greatest + slack


class _Search:
    """The anchors of a task against all blocks."""

    def __init__(self, layout: Layout, zones: str, ids, labels, q, positives, negatives, window):
        self.layout, self.zones = layout, zones
        self.ids, self.labels, self.q = ids, labels, q
        self.window, self.read = window, 0
        self.pos = Best(len(ids), positives)
        self.neg = None
        self.negatives = negatives

    def scan(self, wanted, take) -> None:
        """``wanted(strip, zones, least, greatest)``: which anchors (rows) lack
        something of which blocks (columns); ``take`` gets their scores."""
        files = _Files(self.layout)
        kind, dims = self.layout.kind, self.layout.dims
        strips = [slice(a, min(a + STRIP, len(self.ids))) for a in range(0, len(self.ids), STRIP)]
        for page in _pages(self.zones):
            z = {c: page.column(c).to_numpy(zero_copy_only=False)
                 for c in ("row", "label_low", "label_high")}
            z["file"] = page.column("file").to_pylist()
            low, high = (np.frombuffer(b"".join(page.column(c).to_pylist()), kind)
                         .reshape(page.num_rows, dims).astype(np.float64) for c in ("low", "high"))
            bounds = [interval_bounds(self.q[s], low, high) for s in strips]
            hope = np.full(page.num_rows, -np.inf)
            for s, (least, greatest) in zip(strips, bounds):
                hope = np.maximum(hope, np.where(wanted(s, z, least, greatest), greatest,
                                                 -np.inf).max(0, initial=-np.inf))
            for b in np.argsort(-hope, kind="stable"):
                if hope[b] == -np.inf:
                    break
                one = {c: v[b:b + 1] for c, v in z.items()}
                held = None
                for s, (least, greatest) in zip(strips, bounds):
                    need = wanted(s, one, least[:, b:b + 1], greatest[:, b:b + 1])[:, 0]
                    if need.any():
                        if held is None:
                            held = files.block(z["file"][b], int(z["row"][b]))
                            self.read += 1
                        at = np.flatnonzero(need) + s.start
                        take(at, exact_scores(self.q[at], held[2]), held[0], held[1])
            files.close()

    # Positives: the best rows of the anchor's own label.
    def own_label(self, s, z, least, greatest):
        lab = self.labels[s, None]
        return ((z["label_low"] <= lab) & (lab <= z["label_high"])
                & (greatest >= self.pos.least(s)[:, None]))

    def take_own(self, at, score, ids, labels):
        ok = ((labels == self.labels[at, None]) & (ids != self.ids[at, None])
              & (score >= self.pos.least(at)[:, None]))
        a, j = np.nonzero(ok)
        self.pos.add(at[a], score[a, j], ids[j])

    # Negatives: for each anchor and positive the best rows inside the window.
    def other_label(self, s, z, least, greatest):
        lab = self.labels[s, None]
        other = (z["label_low"] != lab) | (z["label_high"] != lab)
        need = np.zeros(least.shape, bool)
        for p in range(self.pos.k):
            w = np.arange(s.start, s.stop) * self.pos.k + p
            need |= ((greatest >= np.maximum(self.low[w], self.neg.least(w))[:, None])
                     & (least <= self.high[w][:, None]))
        return other & need

    def take_other(self, at, score, ids, labels):
        other = labels != self.labels[at, None]
        for p in range(self.pos.k):
            w = at * self.pos.k + p
            ok = (other & (score <= self.high[w][:, None])
                  & (score >= np.maximum(self.low[w], self.neg.least(w))[:, None]))
            a, j = np.nonzero(ok)
            self.neg.add(w[a], score[a, j], ids[j])

    def run(self) -> pa.RecordBatch:
        self.scan(self.own_label, self.take_own)
        score = self.pos.score.ravel()
        empty = score == _NONE
        few, most = self.window
        safe = np.where(empty, 0, score)
        self.low = np.where(empty, TOP, -((-few * safe) // 100))
        self.high = np.where(empty, -TOP, (most * safe) // 100)
        self.neg = Best(len(score), self.negatives)
        self.scan(self.other_label, self.take_other)
        w, r = np.nonzero(self.neg.score != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[w // self.pos.k]), pa.array(self.pos.id.ravel()[w]),
             pa.array((r + 1).astype(np.int32)), pa.array(self.neg.id[w, r]),
             pa.array(score[w]), pa.array(self.neg.score[w, r])],
            names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                   "negative_score"])


def _mined(layout: Layout, zones: str, positives: int, negatives: int, window: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def search():
            t = pa.Table.from_batches(held)
            held.clear()
            q = np.frombuffer(b"".join(t.column("values").to_pylist()), layout.kind).reshape(
                t.num_rows, layout.dims).astype(np.float64)
            ids, labels = (t.column(c).to_numpy() for c in ("id", "label"))
            return _Search(layout, zones, ids, labels, q, positives, negatives, window).run()

        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                part = batch.slice(a, CHUNK)
                if held and sum(b.num_rows for b in held) + part.num_rows > CHUNK:
                    yield search()
                held.append(part)
        if sum(b.num_rows for b in held):
            yield search()
    return run


def mine(df: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score,
    negative_score) for the rows that the condition ``anchors`` holds for: their
    ``positives`` best rows of the same label, and for each the ``negatives`` best
    rows of other labels whose score lies in the window (per cents of the positive's)."""
    v = F.col(vector_col).cast("array<double>")
    ok = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()
          & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    src = df.filter(ok).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        v.alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    layout = Layout(src.select("v"), scale)
    rows = stage(src.mapInArrow(_placed(layout), "id long, label long, place long, values binary, "
                                "anchor boolean"), "negatives_rows")
    blocks = Blocks(rows, layout)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "place", "id"]
    mine_ = (rows.filter("anchor").drop("anchor").distinct()
             .repartitionByRange(tasks, *order).sortWithinPartitions(*order))
    return mine_.mapInArrow(
        _mined(layout, blocks.zones, positives, negatives, window),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
        "negative_score long")
