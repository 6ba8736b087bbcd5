"""SentencePiece-style encoding: unigram Viterbi over a double-array trie.

A piece vocabulary with scores becomes a double-array trie (two integer arrays;
one addition and one comparison per character). A text is normalised the way the
vocabulary expects (blanks become the white-space marker, one marker in front)
and cut by Viterbi search into the pieces with the highest total score. A
character that no piece covers is one step with a penalty and is written as its
UTF-8 bytes (byte fallback). Decoding joins pieces and bytes and turns markers
back into blanks.

Scores are the file's log scores (see :func:`log_scores` for vocabularies that
hold merge ranks). The search is exact; because no
piece crosses the start of a marked word, whole texts are searched word by word
and words are remembered (a bounded memo per worker). If a vocabulary has a
piece that does cross, texts are searched in one go.

Null and empty texts have no pieces and decode to the empty text. The one thing
that does not come back is a literal marker character (U+2581), which decodes to
a blank. Rows are independent; ids, repeats and extra columns do not matter.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: The penalty of an uncovered character, below the lowest piece score.
UNKNOWN_PENALTY = 10.0
MEMO = 500_000
_NEG = float("-inf")
_CHUNK = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


def public_model(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class DoubleArray:
    """A trie over characters: the child of node s by code c is base[s] + c, if
    check there is s. value holds the piece id of a node, or -1."""

    def __init__(self, pieces: dict[str, int]):
        # Frequent characters get small codes, which keeps the arrays dense.
        freq = Counter(c for p in pieces for c in p)
        self.code = {c: i + 1 for i, (c, _) in enumerate(
            sorted(freq.items(), key=lambda e: (-e[1], e[0])))}
        root: dict = {}
        for p, i in pieces.items():
            node = root
            for c in p:
                node = node.setdefault(self.code[c], {})
            node[0] = i
        base, check, value = [0], [-1], [-1]

        def grow(n: int) -> None:
            more = n + 1 - len(base)
            if more > 0:
                base.extend([0] * more)
                check.extend([-1] * more)
                value.extend([-1] * more)

        todo, hint = [(root, 0)], 1
        while todo:
            node, s = todo.pop()
            value[s] = node.get(0, -1)
            codes = sorted(c for c in node if c)
            if not codes:
                continue
            b = tried = max(1, hint - codes[0])
            while True:
                grow(b + codes[-1])
                if all(check[b + c] == -1 for c in codes):
                    break
                b += 1
            if b - tried > 32:  # a crowded stretch: later nodes start beyond it
                hint = b
            base[s] = b
            for c in codes:
                check[b + c] = s
            todo += [(node[c], b + c) for c in codes]
        # A walk may look one alphabet beyond the last used cell.
        grow(len(base) + len(self.code) + 1)
        self.base, self.check, self.value = base, check, value


def log_scores(pieces: dict[int, tuple[str, float]]) -> dict[int, tuple[str, float]]:
    """Pieces with log-probabilities. A unigram vocabulary has them already; one
    that was made by merging holds negative merge ranks instead (integers), which
    become the log-probabilities of a Zipf distribution over the ranks."""
    if not all(s <= 0 and float(s).is_integer() for _, s in pieces.values()):
        return pieces
    order = sorted(pieces, key=lambda i: (-pieces[i][1], i))
    total = math.log(sum(1.0 / (r + 2.7) for r in range(len(order))))
    return {i: (pieces[i][0], -math.log(r + 2.7) - total) for r, i in enumerate(order)}


class PieceCodec:
    """Encoder and decoder of one vocabulary. ``pieces`` are (text, score) of the
    ordinary pieces by id; ``byte_ids`` the ids of the 256 byte pieces."""

    def __init__(self, pieces: dict[int, tuple[str, float]], byte_ids: list[int],
                 dummy_prefix: bool = True):
        self.score = {i: s for i, (_, s) in pieces.items()}
        self.trie = DoubleArray({p: i for i, (p, _) in pieces.items()})
        self.byte_ids, self.prefix = byte_ids, MARK if dummy_prefix else ""
        self.unknown = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {i: p.encode() for i, (p, _) in pieces.items()}
        self.bytes.update({i: bytes([b]) for b, i in enumerate(byte_ids)})
        self.whole = any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p, re.S)
                         for p, _ in pieces.values())
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> PieceCodec:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, [0] * 256
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[i] = (sp.id_to_piece(i), sp.get_score(i))
        return cls(log_scores(pieces), byte_ids)

    def viterbi(self, text: str) -> list[int]:
        """The best segmentation of normalised text; ties go to the segmentation
        found first, from the left and with the shorter last piece."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        score, unknown = self.score, self.unknown
        codes = [self.trie.code.get(c, 0) for c in text]
        n = len(codes)
        best, back, piece = [0.0] + [_NEG] * n, [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            here, s, single = best[i], 0, False
            for j in range(i, n):
                c = codes[j]
                if not c:
                    break
                t = base[s] + c
                if check[t] != s:
                    break
                s = t
                v = value[s]
                if v >= 0:
                    x = here + score[v]
                    if j == i:
                        single = True
                    if x > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = x, i, v
            if not single and here + unknown > best[i + 1]:
                best[i + 1], back[i + 1], piece[i + 1] = here + unknown, i, -1
        out, at = [], n
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out.extend(self.byte_ids[b] for b in
                           reversed(text[back[at]:at].encode("utf-8", "replace")))
            at = back[at]
        out.reverse()
        return out

    def _chunk(self, chunk: str) -> bytes:
        got = self.memo.get(chunk)
        if got is None:
            got = self.older.get(chunk)
            if got is None:
                got = array("I", self.viterbi(chunk)).tobytes()
            if len(self.memo) > MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[chunk] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """Piece ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        norm = self.prefix + text.replace(" ", MARK)
        if self.whole:
            return array("I", self.viterbi(norm)).tobytes()
        chunks, memo = _CHUNK.findall(norm), self.memo
        try:
            return b"".join([memo[c] for c in chunks])
        except KeyError:
            return b"".join([self._chunk(c) for c in chunks])

    def decode(self, ids: bytes | None) -> str:
        if not ids:
            return ""
        raw = b"".join(map(self.bytes.__getitem__, array("I", ids)))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _mapped(path: str, at: int, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec.load(path)
        for batch in batches:
            names = [*(f"c{i}" for i in range(batch.num_columns)), "out"]
            values = batch.column(at).to_pylist()
            out = (pa.array([codec.decode(v) for v in values], pa.string()) if decode else
                   pa.array([codec.encode(v) for v in values], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=names)
    return run


def _with(df: DataFrame, path: str | None, col: str, out: str, decode: bool) -> DataFrame:
    kind = T.StringType() if decode else T.BinaryType()
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)]
                          + [T.StructField("out", kind)])
    return df.mapInArrow(_mapped(path or public_model(), df.columns.index(col), decode),
                         schema).toDF(*df.columns, out)


def encode_column(df: DataFrame, path: str | None = None, text_col: str = "text",
                  out: str = "piece_ids") -> DataFrame:
    """``df`` with a binary column of piece ids (little-endian, 32 bits each)."""
    return _with(df, path, text_col, out, decode=False)


def decode_column(df: DataFrame, path: str | None = None, ids_col: str = "piece_ids",
                  out: str = "decoded") -> DataFrame:
    """``df`` with the text that the piece ids stand for."""
    return _with(df, path, ids_col, out, decode=True)


def summary(df: DataFrame, path: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and whether the decoded text is the text."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    both = decode_column(encode_column(src, path), path)
    return both.select(
        "doc_id", F.floor(F.octet_length("piece_ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("piece_ids").alias("ids_crc32"),
        (F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" ")))
        .alias("round_trip"))
