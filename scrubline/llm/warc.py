"""WARC archives: written as one gzip stream a file, then normalised so that every
record is a gzip member of its own with a sidecar offset index.

1. :func:`write_archives`: every task writes its rows as ``response`` records into
   archives of about ``ARCHIVE_BYTES`` payload bytes, each one gzip stream from
   end to end, and logs (archive, position, id, size, digest) of its records.
2. :func:`repeats`: from that log (no payloads are shuffled) the records whose
   payload is already held by another one.
3. :func:`normalise`: inflates every archive once, as a stream, and rewrites each
   record as its own member; a repeated payload becomes a ``revisit`` record
   without one. Beside the archive goes its index, a line per record with the
   member's offset and length.
4. :func:`read_records`: seeks to the indexed offsets and inflates single members.

Files are written under the shared folder by names that are new for every task
attempt; the table that a step stages names the files of the attempts that Spark
accepted, so a lost executor or a second attempt leaves at most files that nothing
refers to. A task holds one record at a time. The shared folder has to be one that
pyarrow's file systems reach (a mounted folder, hdfs, s3, gs, abfs).

Defined cases: a null or empty payload is a record with no payload bytes; a null
url leaves the target out; url bytes beyond printable ASCII are percent-encoded. A null id is
smaller than any other. Rows are rows: those that repeat an id have a record each;
of the records that share the largest id one holds the payload and the others
refer to it. An archive that ends early is read up to its last whole record and
marked as truncated. Empty tables give no archives. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import file_system, stage

ARCHIVE_BYTES = 256 << 20
#: Payloads from this size on are stored once.
MIN_SHARED = 1000
LEVEL = 6
CHUNK = 1 << 18
#: Fixed value: the profile of revisit records in the WARC format.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LOG = ("archive string, position long, id long, url string, record_id string, "
        "payload_bytes long, payload_digest string")
_MANIFEST = "source string, archive string, index string, records long, truncated boolean"


def _create(uri: str):
    system, path = file_system(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)  # not by the name's ending


# --- records ----------------------------------------------------------------

def head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def http_head(payload_bytes: int) -> bytes:
    return ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()


def _target(url: str | None) -> str | None:
    if url is None:
        return None
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in url.encode())


def _hex(digest: str) -> str:
    """``sha1:BASE32`` as bare hex."""
    name, _, value = digest.partition(":")
    if name.lower() != "sha1":
        raise ValueError(f"payload digest {digest!r} is not SHA-1")
    return base64.b32decode(value).hex() if len(value) == 32 else value.lower()


def _labelled(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


class Truncated(Exception):
    """The stream ends inside a record."""


class Inflated:
    """The bytes of a gzip stream (one member or many), a chunk at a time."""

    def __init__(self, source):
        self.source, self.held, self.at = source, b"", 0
        self.zip, self.spare = None, b""  # between two members

    def _more(self) -> bool:
        """Another chunk; False at the end of the last member."""
        while True:
            if self.zip is None:
                raw = self.spare or self.source.read(CHUNK)
                if not raw:
                    return False
                self.spare = raw.lstrip(b"\0")  # padding between members
                if not self.spare:
                    continue
                self.zip = zlib.decompressobj(31)
            raw = self.spare or self.zip.unconsumed_tail or self.source.read(CHUNK)
            self.spare = b""
            try:
                new = self.zip.decompress(raw, CHUNK)
            except zlib.error as e:
                raise Truncated(str(e)) from e
            if not new and not raw:
                raise Truncated("the gzip stream has no end")
            if self.zip.eof:
                self.spare, self.zip = self.zip.unused_data, None
            if new:
                self.held, self.at = self.held[self.at:] + new, 0
                return True

    def line(self) -> bytes:
        """Up to and with the next line end; b"" at the end of the stream."""
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                if self.at < len(self.held):
                    raise Truncated("no line end")
                return b""
        out, self.at = self.held[self.at:end + 1], end + 1
        return out

    def chunks(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes."""
        while n:
            if self.at == len(self.held) and not self._more():
                raise Truncated(f"{n} bytes are missing")
            out = self.held[self.at:self.at + n]
            self.at += len(out)
            n -= len(out)
            yield out


def next_head(stream: Inflated) -> list[tuple[str, str]] | None:
    """The named fields of the next record, None at the end."""
    line = stream.line()
    while line in (b"\r\n", b"\n"):
        line = stream.line()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    fields: list[tuple[str, str]] = []
    while (line := stream.line().decode("utf-8", "replace").rstrip("\r\n")):
        if line[0] in " \t" and fields:  # a folded field
            fields[-1] = (fields[-1][0], fields[-1][1] + " " + line.strip())
        else:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    return fields


def _get(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


# --- writing ----------------------------------------------------------------

def _writer(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"{folder}/whole-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        out = gz = None
        made = position = held = 0
        try:
            for batch in batches:
                log = []
                for i, url, payload in zip(*(batch.column(k) for k in range(3))):
                    if out is None:
                        archive = f"{name}-{made:04d}.warc.gz"
                        out, gz = _create(archive), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        made, position, held = made + 1, 0, 0
                        info = b"format: WARC File Format 1.1\r\n"
                        out.write(gz.compress(head([
                            ("WARC-Type", "warcinfo"),
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                            ("WARC-Date", date), ("Content-Type", "application/warc-fields"),
                            ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n"))
                    position += 1
                    body = payload.as_py() or b""
                    digest, page = hashlib.sha1(body).hexdigest(), i.as_py()
                    record_id = (f"<urn:x-row:{'' if page is None else page}:"
                                 f"{archive.rsplit('/', 1)[1].split('.')[0]}:{position}>")
                    web, target = http_head(len(body)), _target(url.as_py())
                    out.write(gz.compress(head(
                        [("WARC-Type", "response"), ("WARC-Record-ID", record_id),
                         ("WARC-Date", date)]
                        + ([("WARC-Target-URI", target)] if target is not None else [])
                        + [("WARC-Payload-Digest", _labelled(digest)),
                           ("Content-Type", "application/http; msgtype=response"),
                           ("Content-Length", str(len(web) + len(body)))]) + web))
                    out.write(gz.compress(body))
                    out.write(gz.compress(b"\r\n\r\n"))
                    log.append((archive, position, page, target, record_id, len(body), digest))
                    held += len(body)
                    if held >= archive_bytes:
                        out.write(gz.flush())
                        out.close()
                        out = None
                if log:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*log), (
                            pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                            pa.int64(), pa.string()))],
                        names=["archive", "position", "id", "url", "record_id", "payload_bytes",
                               "payload_digest"])
            if out is not None:
                out.write(gz.flush())
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
                   date: str | None = None) -> DataFrame:
    """A ``response`` record per row, in archives of one gzip stream each. Returns
    the staged log: archive, position (from 1), id, url, record_id, payload_bytes,
    payload_digest (hex SHA-1)."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                    F.col(payload_col).cast("binary").alias("payload"))
    folder = shared_path(df.sparkSession, "llm", "warc_whole")
    return stage(src.mapInArrow(_writer(folder, date, archive_bytes), _LOG), "warc_log")


def repeats(log: DataFrame, min_bytes: int = MIN_SHARED) -> DataFrame:
    """(archive, position, refers_id, refers_url) of the records whose payload of
    at least ``min_bytes`` another record holds: the one with the largest id."""
    shared = log.filter(F.col("payload_bytes") >= min_bytes)
    keeper = F.max(F.struct("id", "archive", "position", "record_id", "url")).alias("keeper")
    groups = stage(shared.groupBy("payload_digest", "payload_bytes")
                   .agg(F.count(F.lit(1)).alias("n"), keeper).filter("n > 1"), "warc_groups")
    found = shared.join(groups, ["payload_digest", "payload_bytes"]).filter(
        (F.col("archive") != F.col("keeper.archive")) | (F.col("position") != F.col("keeper.position")))
    return found.select("archive", "position", F.col("keeper.record_id").alias("refers_id"),
                        F.col("keeper.url").alias("refers_url"))


# --- normalising ------------------------------------------------------------

def _revisit(fields: list[tuple[str, str]], refers_id: str, refers_url: str | None,
             block_bytes: int) -> bytes:
    out = []
    for k, v in fields:
        if k.lower() == "warc-type":
            out += [(k, "revisit"), ("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", refers_id)]
            if refers_url is not None:
                out.append(("WARC-Refers-To-Target-URI", refers_url))
        elif k.lower() == "content-length":
            out.append((k, str(block_bytes)))
        elif k.lower() != "warc-block-digest":
            out.append((k, v))
    return head(out)


def _web_head(chunks: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The HTTP head of a block and the rest of its chunks."""
    held = b""
    for c in chunks:
        held += c
        if (end := held.find(b"\r\n\r\n")) >= 0:
            return held[:end + 4], iter([held[end + 4:]])
    return held, iter(())


def normalise_stream(source, target, index, known: dict[int, tuple[str, str | None]]):
    """Rewrite one archive. ``known``: position -> (record id, url) that a repeated
    payload refers to; positions count the records that are no ``warcinfo``.
    Returns (records, truncated)."""
    stream, at, n, position = Inflated(source), 0, 0, 0
    while True:
        try:
            fields = next_head(stream)
            if fields is None:
                return n, False
            kind = (_get(fields, "WARC-Type") or "").lower()
            position += kind != "warcinfo"
            block = stream.chunks(int(_get(fields, "Content-Length") or 0))
            gz, member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), []
            if kind == "response" and position in known:
                web, rest = _web_head(block)
                for _ in rest:
                    pass
                for _ in block:
                    pass
                kind = "revisit"
                member.append(gz.compress(_revisit(fields, *known[position], len(web)) + web))
            else:
                member.append(gz.compress(head(fields)))
                member += [gz.compress(c) for c in block]
            member += [gz.compress(b"\r\n\r\n"), gz.flush()]
        except Truncated:
            return n, True
        length = sum(map(len, member))
        for m in member:
            target.write(m)
        index.write((json.dumps({"offset": at, "length": length, "type": kind,
                                 "record_id": _get(fields, "WARC-Record-ID"),
                                 "url": _get(fields, "WARC-Target-URI")}) + "\n").encode())
        at, n = at + length, n + 1


def _normaliser(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                source, known = (batch.column(k)[row].as_py() for k in (0, 1))
                known = {r["position"]: (r["refers_id"], r["refers_url"]) for r in known or ()}
                stem = source.rsplit("/", 1)[1].removesuffix(".warc.gz")
                archive = f"{folder}/{stem}-{uuid.uuid4().hex[:12]}.warc.gz"
                system, path = file_system(source)
                with (system.open_input_stream(path, compression=None) as src,
                      _create(archive) as out, _create(archive + ".idx") as idx):
                    n, cut = normalise_stream(src, out, idx, known)
                yield pa.RecordBatch.from_pydict({
                    "source": pa.array([source]), "archive": pa.array([archive]),
                    "index": pa.array([archive + ".idx"]), "records": pa.array([n], pa.int64()),
                    "truncated": pa.array([cut])})
    return run


def _dealt(archives: DataFrame) -> DataFrame:
    """One row per archive, dealt evenly over the tasks."""
    most = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(max(1, min(most, archives.count())))


def normalise(archives: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rewrite the archives named in the column ``archive``, one gzip member per
    record. ``known`` (:func:`repeats`): records that become revisits. Returns the
    staged manifest: source, archive, index, records, truncated."""
    names = archives.select("archive").distinct()
    entry = F.struct("position", "refers_id", "refers_url")
    if known is None:
        work = names.withColumn("known", F.lit(None).cast(
            "array<struct<position:long,refers_id:string,refers_url:string>>"))
    else:  # an archive's own records: bounded by its size
        work = names.join(known.groupBy("archive").agg(F.collect_list(entry).alias("known")),
                          "archive", "left")
    work = stage(work, "warc_work")
    folder = shared_path(archives.sparkSession, "llm", "warc_members")
    return stage(_dealt(work).mapInArrow(_normaliser(folder), _MANIFEST), "warc_manifest")


def find_archives(spark: SparkSession, path: str) -> DataFrame:
    """The archives under a path or glob, for :func:`normalise`."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"))


# --- reading ----------------------------------------------------------------

_INDEX = "archive string, offset long, length long, type string, record_id string, url string"
_RECORD = ("id long, url string, record_id string, record_type string, payload_bytes long, "
           "payload_digest string, refers_id string, refers_to long, payload binary")


def _index_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, index in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
            system, path = file_system(index)
            with system.open_input_stream(path, compression=None) as src:
                rows = [json.loads(x) for x in src.read().decode().splitlines()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([archive] * len(rows), pa.string())]
                + [pa.array([r[k] for r in rows], t) for k, t in (
                    ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()),
                    ("record_id", pa.string()), ("url", pa.string()))],
                names=["archive", "offset", "length", "type", "record_id", "url"])


def read_index(manifest: DataFrame) -> DataFrame:
    """The sidecar indexes: archive, offset, length, type, record_id, url."""
    return _dealt(manifest.select("archive", "index")).mapInArrow(_index_lines, _INDEX)


def _row_id(record_id: str | None) -> int | None:
    m = re.match(r"<urn:x-row:(-?\d+):", record_id or "")
    return int(m[1]) if m else None


def parse_member(member: bytes, payload: bool) -> dict:
    """A record from its gzip member alone."""
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n") + 4
    fields = [(k.strip(), v.strip()) for k, _, v in (
        x.partition(":") for x in raw[:end].decode("utf-8", "replace").split("\r\n")[1:] if x)]
    block = raw[end:end + int(_get(fields, "Content-Length") or 0)]
    kind = (_get(fields, "WARC-Type") or "").lower()
    cut = block.find(b"\r\n\r\n") + 4 if kind in ("response", "revisit") else 0
    web, body = block[:cut], block[cut:]
    if kind == "revisit":  # size and digest of the payload it refers to
        told = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", web)
        size, digest = int(told[1]) if told else None, _get(fields, "WARC-Payload-Digest")
        digest = _hex(digest) if digest else None
    else:
        size, digest = len(body), hashlib.sha1(body).hexdigest()
        told = _get(fields, "WARC-Payload-Digest")
        if kind == "response" and told and _hex(told) != digest:
            raise ValueError(f"{_get(fields, 'WARC-Record-ID')}: payload differs from its digest")
    refers = _get(fields, "WARC-Refers-To")
    record_id = _get(fields, "WARC-Record-ID")
    return {"id": _row_id(record_id), "url": _get(fields, "WARC-Target-URI"),
            "record_id": record_id, "record_type": kind, "payload_bytes": size,
            "payload_digest": digest, "refers_id": refers, "refers_to": _row_id(refers),
            "payload": body if payload and kind != "revisit" else None}


def _reader(payload: bool):
    kinds = {"id": pa.int64(), "url": pa.string(), "record_id": pa.string(),
             "record_type": pa.string(), "payload_bytes": pa.int64(),
             "payload_digest": pa.string(), "refers_id": pa.string(), "refers_to": pa.int64(),
             "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, src = None, None
        for batch in batches:
            rows, held = [], 0
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if archive != name:
                    if src is not None:
                        src.close()
                    system, path = file_system(archive)
                    name, src = archive, system.open_input_file(path)
                src.seek(offset)
                r = parse_member(src.read(length), payload)
                rows.append(r)
                held += len(r["payload"] or b"")
                if held > CHUNK * 16:  # a batch of bounded size
                    yield _batch(rows, kinds)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, kinds)
        if src is not None:
            src.close()
    return run


def _batch(rows: list[dict], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t)
                                       for k, t in kinds.items()], names=list(kinds))


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that ``index`` rows point at, each inflated alone: id (of the row
    that was written), url, record_id, record_type, payload_bytes and payload_digest
    (of a revisit: of the payload it refers to), refers_id, refers_to (that record's
    id) and payload (null for revisits or unless asked for)."""
    return index.select("archive", "offset", "length").mapInArrow(_reader(payload), _RECORD)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = MIN_SHARED) -> DataFrame:
    """Write, normalise: the manifest of archives with one member per record."""
    log = write_archives(pages, id_col, url_col, payload_col)
    return normalise(log, repeats(log, min_bytes))
