"""Packing by concatenate-and-cut.

Pass 1 encodes every document (each partition on its own) and stages its ids
with two coordinates: the partition and the number of ids before the document
inside that partition. Pass 2 adds up the partition totals -- one row per
partition -- so that every document gets a global offset in the one long
stream of ids; the stream is cut into fixed windows, and a document that
crosses a cut is returned as several pieces (the boundary records). No row is
shuffled; a hot source or a very long text only makes more pieces.

Partition numbers are data of the staged table, so a task that runs again
after a lost executor changes nothing. A null or empty text is the closing id
alone. Null ids and repeated rows are packed like any other row. Extra columns
are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SEQUENCE = 2048
END_ID = 1
ID_BYTES = 4
#: The byte-level vocabulary's pre-split (fixed value), with and without its
#: look-ahead. The look-ahead only matters where white space follows white
#: space; elsewhere the plain form cuts alike and is matched much faster.
PRESPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRESPLIT_PLAIN = PRESPLIT.replace(r"|\s+(?!\S)", "")
_SPACE_RUN = re.compile(r"\s\s")


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The rank file of the vocabulary ``byte_bpe_50k.json`` (same ids)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def added_tokens(name: str = "byte_bpe_50k.json") -> dict[str, int]:
    """The strings that the vocabulary's JSON file gives ids of their own."""
    with open(public_vocabulary(name), encoding="utf-8") as f:
        return {t["content"]: int(t["id"]) for t in json.load(f)["added_tokens"]}


class TextEncoder:
    """Whole texts to little-endian unsigned 32-bit ids. ``added`` strings become
    their one id wherever they stand, as with the vocabulary's JSON file; without
    it, control strings are ordinary text. No other ids are added."""

    def __init__(self, path: str, added: dict[str, int] | None = None):
        import base64

        import tiktoken

        self.added = dict(added or {})
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f)}
        self.exact, self.plain = (
            tiktoken.Encoding(name, pat_str=pat, mergeable_ranks=ranks,
                              special_tokens=self.added)
            for name, pat in (("exact", PRESPLIT), ("plain", PRESPLIT_PLAIN)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        enc = self.exact if _SPACE_RUN.search(text) else self.plain
        if any(t in text for t in self.added):
            return array("I", enc.encode(text, allowed_special="all")).tobytes()
        return array("I", enc.encode_ordinary(text)).tobytes()


def _encode_partition(path: str, end_id: int, added: dict[str, int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, enc = TaskContext.get().partitionId(), 0, TextEncoder(path, added)
        end = end_id.to_bytes(ID_BYTES, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = (batch.column(i).slice(at, 256) for i in (0, 1))
                enc_ids = [enc.encode(t) + end for t in texts.to_pylist()]
                starts = []
                for b in enc_ids:
                    starts.append(before)
                    before += len(b) // ID_BYTES
                n = len(enc_ids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([part] * n, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array([len(b) // ID_BYTES for b in enc_ids], pa.int64()),
                     pa.array(enc_ids, pa.binary())],
                    names=["doc_id", "part", "local_start", "doc_tokens", "ids"])
    return run


def encode_documents(df: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id",
                     text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """Pass 1: (doc_id, part, local_start, doc_tokens, ids), staged."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage(src.mapInArrow(
        _encode_partition(path, end_id, added),
        "doc_id long, part long, local_start long, doc_tokens long, ids binary"), "packed_ids")


def pack(df: DataFrame, path: str | None = None, length: int = SEQUENCE, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text",
         added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it), length,
    doc_tokens, sequence_id, offset (in that sequence) and ids (little-endian
    unsigned 32-bit). Every sequence but the last is full: no id is padding.
    ``added``: strings with ids of their own (:func:`added_tokens`)."""
    enc = encode_documents(df, path or public_vocabulary(), end_id, id_col, text_col, added)
    # One row per partition of pass 1: the window and the broadcast are bounded
    # by the number of input splits.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (enc.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    at = (enc.join(F.broadcast(offsets), "part")
          .withColumn("g", F.col("part_start") + F.col("local_start")))
    seq = F.explode(F.sequence(F.floor(F.col("g") / length),
                               F.floor((F.col("g") + F.col("doc_tokens") - 1) / length)))
    cut = at.withColumn("sequence_id", seq).withColumn(
        "start", F.greatest(F.lit(0), F.col("sequence_id") * length - F.col("g")))
    cut = cut.withColumn("length", F.least(
        F.col("doc_tokens"), (F.col("sequence_id") + 1) * length - F.col("g")) - F.col("start"))
    return cut.select(
        "doc_id", F.col("start").cast("long"), F.col("length").cast("long"), "doc_tokens",
        F.col("sequence_id").cast("long"),
        (F.col("g") + F.col("start") - F.col("sequence_id") * length).cast("long").alias("offset"),
        F.substring(F.col("ids"), (F.col("start") * ID_BYTES + 1).cast("int"),
                    (F.col("length") * ID_BYTES).cast("int")).alias("ids"))


def with_digest(pieces: DataFrame) -> DataFrame:
    """Replace the ids of each piece by their CRC-32."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
