"""Toxicity scores of texts restored by a noisy-channel decoder.

1. A character trigram model is counted over *all* documents (per-task numpy
   counts, summed by Spark; at most ``CLASSES ** 3`` cells whatever the input).
2. Tokens that look disguised -- digits or symbols among letters or at the ends
   of a word (read with and without them), symbols alone, letters run
   on three times or more, letters spaced out one by one -- become a lattice:
   a symbol may stand for a letter, be an inserted separator, and a repeated
   letter may be one letter. Viterbi search (over trigram states) picks the
   reading that the channel and the character model make likeliest. Other
   tokens have a one-path lattice and are taken as they stand.
3. Evidence is learnt from a bounded sample of labelled rows (at most
   ``SAMPLE`` of either label, drawn by a hash): restored words and word
   beginnings, selected greedily by the toxic texts they explain beyond those
   already explained, so that words which merely come along in copies of a
   toxic text are not taken for toxic. A document's score is the chance that at
   least one of its pieces of evidence is right (noisy-or).

Only the text enters a score. Null and empty texts get the base score. Repeated
rows, null ids and extra columns (passed through by :func:`with_scores`) are
harmless; without labelled rows every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stage

#: Labelled rows of either label that the evidence is learnt from, at most.
SAMPLE = 4000
#: Candidate features kept for the greedy selection, at most.
CANDIDATES = 5000
MIN_SUPPORT = 3
THRESHOLD = 0.5

CLASSES = 64
#: Letters with a class of their own; other letters share the last class and
#: everything else is a word boundary (class 0).
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâäæçèéêëìíîïñòóôöøùúûüœ"
_OTHER = CLASSES - 1
#: Letters that a symbol may stand for (fixed values of the channel).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
        "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
        "€": "e", "£": "l", "¡": "i", "*": "aeiou"}
SEPARATORS = set(" .-_*'~/\\,:;^=#%&")
#: Log-probabilities of the channel.
KEEP, SWAP, INSERT, REPEAT = -0.05, -3.5, -3.0, -1.2
SWAP_AGAIN, DROP_DIGIT = -1.0, -9.0
MEMO = 200_000

_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(])(?:[ ._*-]{1,2}(?:[^\W_]|[@$!|+(])){2,}(?!\w)")
_RUNS = re.compile(r"(.)\1+")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")
#: What a text must hold before its tokens are looked at one by one.
_TRIPLES = [c * 3 for c in LETTERS]
_SYMBOL = re.compile(r"[0-9@$!|+(*€£¡_~^=#%&/\\'’-]")
_INNER_DOT = re.compile(r"\.[^\W\d_]")
_SPACED_HINT = re.compile(r"\s\S[ ._*-]{1,2}\S[ ._*-]{1,2}\S")
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "…«»“”‘’–—¡¿"

#: Symbols at a token's ends that are no letter in disguise.
_OUTER = "".join(c for c in _EDGE if c not in LEET)
#: Symbols that are punctuation at the ends of a word as often as not.
_MARKS = set("!|+(*¡")
_NUMBER = re.compile(r"[(+-]*[$€£]?\d[\d.,:;/%-]*[$€£+*|(]?!*")


def _class_table() -> np.ndarray:
    table = np.zeros(0x10000, np.uint8)
    for cp in range(0x10000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp).lower()
        if len(c) == 1 and c.isalpha():
            at = LETTERS.find(c)
            table[cp] = at + 1 if at >= 0 else _OTHER
    return table


def _count_trigrams(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            block, size = [], 0
            texts = [t for t in batch.column(0).to_pylist() if t]
            for i, t in enumerate(texts):
                block.append(t)
                size += len(t)
                if size < 1 << 20 and i + 1 < len(texts):
                    continue
                cps = np.frombuffer(("\n" + "\n\n".join(block) + "\n").encode(
                    "utf-32-le", "replace"), np.uint32)
                c = table[np.minimum(cps, 0xFFFF)].astype(np.int32)
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:],
                                     minlength=len(total))
                block, size = [], 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])],
                                         names=["cell", "n"])
    return run


def character_model(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probabilities [a, b, c] of class c after the classes a and b, from all
    texts; smoothed by the bigram and unigram frequencies."""
    cells = (df.select(F.col(text_col).alias("t"))
             .mapInArrow(_count_trigrams(_class_table()), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n"))).toPandas()
    n = np.zeros(CLASSES ** 3)
    n[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    one = (n.sum((0, 1)) + 0.5) / (n.sum() + 0.5 * CLASSES)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2))[:, None] + 5)
    return np.log((n + 2 * two[None]) / (n.sum(2, keepdims=True) + 2)).astype(np.float32)


class Restorer:
    """Viterbi decoding of disguised tokens; remembers what it has decoded."""

    def __init__(self, model: np.ndarray):
        # Plain lists are read much faster than array cells.
        self.lm = model.tolist()
        self.cls = {c: i + 1 for i, c in enumerate(LETTERS)}
        self.memo: dict[str, str] = {}

    def decode(self, token: str) -> str:
        """The likeliest reading of a lower-case token as one word."""
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            got = self.memo[token] = self._viterbi(token)
        return got

    @staticmethod
    def _lattice(token: str) -> list[list[tuple[str | None, float]]]:
        """Per character what it may stand for: (letter or None for nothing,
        log-probability of the channel)."""
        out, last = [], ""
        first, end = (len(token) - len(token.lstrip(_EDGE)), len(token.rstrip(_EDGE)))
        for at, ch in enumerate(token):
            steps: list[tuple[str | None, float]] = []
            if ch.isalpha():
                steps.append((ch, KEEP))
                if ch == last:
                    steps.append((None, REPEAT))
            else:
                swap = SWAP_AGAIN if ch == last else SWAP
                steps += [(x, swap) for x in LEET.get(ch, "")]
                if ch == last:
                    steps.append((None, REPEAT))
                else:
                    mark = ch in SEPARATORS or ch in _MARKS and not first <= at < end
                    steps.append((None, DROP_DIGIT if ch in LEET and not mark else INSERT))
            last = ch
            out.append(steps)
        return out

    def _viterbi(self, token: str) -> str:
        """The best path of the lattice: every state is kept, of which there is at
        most one per pair of letters."""
        lm, cls = self.lm, self.cls
        # state: the last two classes -> (log-probability, back pointer chain)
        states = {(0, 0): (0.0, None)}
        for steps in self._lattice(token):
            new: dict = {}
            for (a, b), (score, chain) in states.items():
                for letter, channel in steps:
                    if letter is None:
                        key, s, c = (a, b), score + channel, chain
                    else:
                        k = cls.get(letter, _OTHER)
                        key, s, c = (b, k), score + channel + lm[a][b][k], (chain, letter)
                    old = new.get(key)
                    if old is None or s > old[0]:
                        new[key] = (s, c)
            states = new
        best = max(((s + lm[a][b][0], chain) for (a, b), (s, chain) in states.items()),
                   key=lambda e: e[0])[1]
        out = []
        while best is not None:
            best, letter = best
            out.append(letter)
        return "".join(reversed(out))

    def words(self, text: str | None) -> tuple[set[str], set[str]]:
        """The distinct lower-case words as they stand, and the restored ones."""
        if not text:
            return set(), set()
        low = "\n" + text.lower()
        plain = set(_WORD.findall(low))
        found = set()
        for run in _TRIPLES:
            if run in low:
                found.update([self.decode(w) for w in plain if run in w])
        if _SYMBOL.search(low) or _INNER_DOT.search(low):
            for token in set(low.split()):
                t, whole = token.strip(_EDGE), token.strip(_OUTER)
                if not t.isalpha() and _LETTER.search(t):
                    found.add(self.decode(t))
                # Symbols at the ends may be letters too, or all there is.
                if whole != t and len(set(whole)) > 1 and not _NUMBER.fullmatch(whole):
                    found.add(self.decode(whole))
        if _SPACED_HINT.search(low):
            found.update([self.decode(x) for x in _SPACED.findall(low)])
        found.discard("")
        return plain, found


def collapse(word: str) -> str:
    """A word with every run of a letter cut to one."""
    return _RUNS.sub(r"\1", word)


def features(words: set[str]) -> set[str]:
    """Whole words and word beginnings of 4 to 6 letters."""
    out = {"=" + w for w in words if len(w) > 2}
    for k in (4, 5, 6):
        out.update([w[:k] for w in words if len(w) >= k])
    return out


@dataclass
class Evidence:
    """What the labelled sample taught: the chance of toxicity per feature."""

    weight: dict[str, float] = field(default_factory=dict)
    base: float = 0.0

    def __post_init__(self):
        self.whole = {f[1:]: p for f, p in self.weight.items() if f[0] == "="}
        self.start = {f: p for f, p in self.weight.items() if f[0] != "="}
        self.lengths = sorted({len(f) for f in self.start})
        # A restored word may have lost or kept a double letter.
        self.runs = {collapse(w): w for w in self.whole}

    def score(self, plain: set[str], restored: set[str]) -> float:
        hits = {self.runs[collapse(w)] for w in restored if collapse(w) in self.runs}
        hits |= self.whole.keys() & plain
        p = [self.whole[w] for w in hits]
        for k in self.lengths:
            starts = {w[:k] for w in plain}
            starts.update([w[:k] for w in restored])
            p += [self.start[f] for f in self.start.keys() & starts]
        return 1.0 - (1.0 - self.base) * math.prod([1.0 - x for x in p])


def usable_labels(labels: DataFrame) -> DataFrame:
    """(i, toxic) of the labelled ids, none of them held out."""
    return (labels.select(F.col("doc_id").cast("long").alias("i"),
                          F.col("toxic").cast("int").alias("toxic"))
            .filter("i is not null and toxic in (0, 1)").groupBy("i").agg(
                F.max("toxic").alias("toxic"))
            .filter(F.crc32(F.col("i").cast("string")) % 5 != 0))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled rows per label, none of them
    held out; distinct texts, toxic if one of a text's labels says so. The drawn ids
    (bounded) are broadcast."""
    kept = usable_labels(labels)
    order = (F.xxhash64("i"), F.col("i"))
    drawn = kept.filter("toxic = 1").orderBy(*order).limit(sample).union(
        kept.filter("toxic = 0").orderBy(*order).limit(sample))
    return (docs.select(F.col("doc_id").cast("long").alias("i"), "text")
            .filter(F.col("text").isNotNull())
            .join(F.broadcast(drawn), "i").groupBy("text").agg(F.max("toxic").alias("toxic")))


def _sample_features(model: np.ndarray, wanted: frozenset | None):
    """Per task: feature counts (wanted is None), or per text its wanted features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        counts = (Counter(), Counter())
        for batch in batches:
            rows = [(features(set.union(*restorer.words(t))), y) for t, y in
                    zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            if wanted is None:
                for f, y in rows:
                    counts[y].update(f)
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sorted(f & wanted) for f, _ in rows], pa.list_(pa.string())),
                     pa.array([y for _, y in rows], pa.int32())], names=["features", "toxic"])
        if wanted is None:
            # A feature that no toxic text has is no evidence.
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()),
                 pa.array([counts[1][f] for f in names], pa.int64()),
                 pa.array([counts[0][f] for f in names], pa.int64())],
                names=["feature", "nt", "nc"])
    return run


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE) -> Evidence:
    """Learn the evidence from the bounded labelled sample."""
    rows = stage(labelled_sample(docs, labels, sample), "toxicity_sample")  # read twice
    counted = (rows.mapInArrow(_sample_features(model, None), "feature string, nt long, nc long")
               .groupBy("feature").agg(F.sum("nt").alias("nt"), F.sum("nc").alias("nc")))
    cand = (counted.filter((F.col("nt") >= MIN_SUPPORT) & (F.col("nt") >= 4 * F.col("nc")))
            .orderBy(F.desc(F.col("nt") - 4 * F.col("nc")), F.length("feature"), "feature")
            .limit(CANDIDATES))
    wanted = frozenset(r.feature for r in cand.select("feature").collect())
    # At most 2 * sample rows of at most CANDIDATES short features each.
    hits = rows.mapInArrow(_sample_features(model, wanted),
                           "features array<string>, toxic int").toPandas()
    share = usable_labels(labels).agg(F.avg("toxic")).first()[0] or 0.0
    return select_evidence([(list(f), int(y)) for f, y in zip(hits["features"], hits["toxic"])],
                           share)


def select_evidence(rows: list[tuple[list[str], int]], share: float) -> Evidence:
    """Greedy cover: take the feature that explains most toxic texts not explained
    yet (four for every clean text it hits), until none explains MIN_SUPPORT."""
    toxic = [set(f) for f, y in rows if y == 1]
    n_toxic, n_clean = len(toxic), len(rows) - len(toxic)
    if not n_toxic:
        return Evidence()
    clean_hits = Counter(x for f, y in rows if y == 0 for x in f)
    all_hits = Counter(x for f in toxic for x in f)
    left, gain = toxic, Counter(all_hits)
    # Clean rows are drawn less often than they occur: weigh them back.
    per_clean = ((1 - share) / max(share, 1e-9)) * n_toxic / max(n_clean, 1)
    weight: dict[str, float] = {}
    while gain:
        best = max(gain, key=lambda f: (gain[f] - 4 * clean_hits[f] * per_clean,
                                        f[0] == "=", -len(f), f))
        if gain[best] - 4 * clean_hits[best] * per_clean < MIN_SUPPORT:
            break
        bad = clean_hits[best] * per_clean
        weight[best] = (all_hits[best] + 0.5) / (all_hits[best] + bad + 1.0)
        left = [f for f in left if best not in f]
        gain = Counter(x for f in left for x in f)
    # The rest of the same vocabulary: features about as frequent as the selected
    # ones and as pure, which the cover left out because others came first.
    if weight:
        enough = max(MIN_SUPPORT, 0.3 * max(all_hits[f] for f in weight))
        for f, n in all_hits.items():
            if n >= enough and f not in weight and 50 * clean_hits[f] * per_clean <= n:
                weight[f] = (n + 0.5) / (n + clean_hits[f] * per_clean + 1.0)
    unexplained = len(left)
    passed = sum(1 for f, y in rows if y == 0 and not any(x in weight for x in f)) * per_clean
    base = min(0.4, unexplained / max(1.0, unexplained + passed))
    return Evidence(weight, base)


def _scored(model: np.ndarray, evidence: Evidence, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            scores = [evidence.score(*restorer.words(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*(f"c{i}" for i in range(batch.num_columns)), "s"])
    return run


def with_scores(df: DataFrame, model: np.ndarray, evidence: Evidence, out: str,
                text_col: str = "text") -> DataFrame:
    """``df`` with a score column (0 to 1) appended; all columns kept."""
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)]
                          + [T.StructField("s", T.DoubleType())])
    at = df.columns.index(text_col)
    return df.mapInArrow(_scored(model, evidence, at), schema).toDF(*df.columns, out)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = character_model(docs)
    evidence = learn(docs, labels, model)
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                         model, evidence, "score")
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score below the threshold, columns unchanged."""
    model = character_model(df)
    evidence = learn(df, labels, model)
    s = fresh(df, "toxicity")
    return with_scores(df, model, evidence, s).filter(F.col(s) < threshold).drop(s)
