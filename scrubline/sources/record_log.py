"""A log of records in partitions, with offsets, kept in files: a topic without a
broker. It is a Spark data source (``record_log``) for batches and streams.

* Writing commits in two phases. Tasks write segments (Parquet files) under names
  that are new for every attempt; the driver then gives them their offsets and adds
  one commit document. What is not committed is not in the log: an aborted batch
  leaves nothing visible. A streaming query names itself (``writer``), and a batch of
  it counts once, however often it is replayed.
* A record's partition is that of its key (CRC-32), or the task's without a key;
  offsets of a partition run 0, 1, 2... without gaps, in the order of the tasks.
* Reading starts at ``earliest``, ``latest`` or explicit offsets (JSON: partition ->
  offset). A stream's checkpoint wins over the start position. Each segment is read by a
  task of its own, from its first wanted record on.
* ``maxRecordsPerTrigger`` bounds what a micro-batch takes, over all partitions,
  for streams that poll; it needs ``progress``, a folder of the query's own beside
  its checkpoint, where the reader notes what it has planned. (With
  ``availableNow`` Spark asks such a source once, so leave the bound out there.)

One job or query writes a log at a time, as with Spark's own file sink. The folder
has to be on a file system that pyarrow reaches (mounted, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import json
import sys
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    DataSourceStreamArrowWriter, DataSourceStreamReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.streaming import StreamingQuery

from ..schemas import KAFKA_RECORD
from .files import file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "record_log"
SEGMENT_RECORDS = 100_000


# --- commits ------------------------------------------------------------------

class Log:
    """The commit documents of a log, in the driver's or a planner's process."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.system, self.root = file_system(self.path)

    def _names(self) -> list[str]:
        from pyarrow import fs

        found = self.system.get_file_info(fs.FileSelector(f"{self.root}/commits",
                                                          allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def _load(self, name: str) -> dict:
        with self.system.open_input_stream(f"{self.root}/commits/{name}") as f:
            return json.loads(f.read())

    def latest(self) -> dict:
        """The newest document: ends (offset after the last record, by partition),
        applied (last batch by writer), number."""
        names = self._names()
        return self._load(names[-1]) if names else {"number": 0, "ends": {}, "applied": {},
                                                    "partitions": 0, "segments": []}

    def segments(self, start: dict, end: dict) -> list[dict]:
        """The segments that hold offsets from ``start`` to before ``end``, in order."""
        want = {p: (start.get(p, 0), e) for p, e in end.items() if start.get(p, 0) < e}
        out = []
        left = set(want)
        for name in reversed(self._names()):
            if not left:
                break
            for s in self._load(name)["segments"]:
                p = str(s["partition"])
                if p in want and s["base"] < want[p][1] and s["base"] + s["n"] > want[p][0]:
                    out.append({**s, "from": max(want[p][0], s["base"]),
                                "to": min(want[p][1], s["base"] + s["n"])})
                    if s["base"] <= want[p][0]:
                        left.discard(p)
        return sorted(out, key=lambda s: (s["partition"], s["base"]))

    def add(self, segments: list[dict], writer: str, batch: int | None, partitions: int) -> None:
        """Give the segments their offsets and make them part of the log."""
        last = self.latest()
        if batch is not None and last["applied"].get(writer, -1) >= batch:
            self.drop(segments)
            return
        ends, placed = dict(last["ends"]), []
        for p in range(max(partitions, last["partitions"])):
            ends.setdefault(str(p), 0)
        for s in segments:
            p = str(s["partition"])
            placed.append({**s, "base": ends[p]})
            ends[p] += s["n"]
        document = {"number": last["number"] + 1, "ends": ends, "segments": placed,
                    "partitions": max(partitions, last["partitions"]),
                    "applied": {**last["applied"], **({} if batch is None else {writer: batch})}}
        self.system.create_dir(f"{self.root}/commits", recursive=True)
        aside = f"{self.root}/commits/.{uuid.uuid4().hex}"
        with self.system.open_output_stream(aside) as f:
            f.write(json.dumps(document).encode())
        self.system.move(aside, f"{self.root}/commits/{document['number']:012d}.json")

    def drop(self, segments: list[dict]) -> None:
        for s in segments:
            self.system.delete_file(f"{self.root}/{s['file']}")


# --- writing ------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    segments: list


class _Writer:
    def __init__(self, options, schema):
        self.path = options["path"]
        self.partitions = int(options.get("partitions", "1"))
        self.name = options.get("writer", "direct")
        self.has_key = "key" in schema.fieldNames()
        if "value" not in schema.fieldNames():
            raise ValueError("a record needs a column `value`")

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        system, root = file_system(self.path.rstrip("/"))
        task = TaskContext.get().partitionId()
        schema = pa.schema([("key", pa.binary()), ("value", pa.binary()),
                            ("timestamp", pa.timestamp("us", "UTC"))])
        open_: dict = {}
        done: list[dict] = []

        def close(p):
            out, sink, entry = open_.pop(p)
            out.close()
            sink.close()
            done.append(entry)

        for batch in iterator:
            value = batch.column(batch.schema.get_field_index("value")).cast(pa.binary())
            key = (batch.column(batch.schema.get_field_index("key")).cast(pa.binary())
                   if self.has_key else pa.nulls(batch.num_rows, pa.binary()))
            now = pa.array([int(time.time() * 1e6)] * batch.num_rows, pa.timestamp("us", "UTC"))
            where = [task % self.partitions if k is None else zlib.crc32(k) % self.partitions
                     for k in key.to_pylist()]
            table = pa.table([key, value, now], schema=schema)
            for p in sorted(set(where)):
                rows = table.filter(pa.array([w == p for w in where]))
                if p not in open_:
                    name = f"segments/p={p}/{uuid.uuid4().hex}.parquet"
                    system.create_dir(f"{root}/segments/p={p}", recursive=True)
                    sink = system.open_output_stream(f"{root}/{name}")
                    open_[p] = (pq.ParquetWriter(sink, schema, compression="zstd"), sink,
                                {"partition": p, "n": 0, "file": name})
                open_[p][0].write_table(rows)
                open_[p][2]["n"] += rows.num_rows
                if open_[p][2]["n"] >= SEGMENT_RECORDS:
                    close(p)
        for p in list(open_):
            close(p)
        return Written(segments=done)

    def _all(self, messages) -> list[dict]:
        return [s for m in messages if m is not None for s in m.segments]


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        Log(self.path).add(self._all(messages), self.name, None, self.partitions)

    def abort(self, messages) -> None:
        Log(self.path).drop(self._all(messages))


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        Log(self.path).add(self._all(messages), self.name, batchId, self.partitions)

    def abort(self, messages, batchId: int) -> None:
        Log(self.path).drop(self._all(messages))


# --- reading ------------------------------------------------------------------

class Segment(InputPartition):
    def __init__(self, path: str, topic: str, entry: dict):
        self.path, self.topic, self.entry = path, topic, entry


def _records(part: Segment) -> Iterator:
    import pyarrow as pa
    import pyarrow.parquet as pq

    e = part.entry
    system, root = file_system(part.path.rstrip("/"))
    with system.open_input_file(f"{root}/{e['file']}") as src:
        at = e["base"]
        for batch in pq.ParquetFile(src).iter_batches(8192):
            lo, hi = max(0, e["from"] - at), min(batch.num_rows, e["to"] - at)
            if lo < hi:
                got, n = batch.slice(lo, hi - lo), hi - lo
                yield pa.RecordBatch.from_arrays(
                    [got.column(0), got.column(1), pa.array([part.topic] * n),
                     pa.array([e["partition"]] * n, pa.int32()),
                     pa.array(range(at + lo, at + hi), pa.int64()), got.column(2),
                     pa.array([0] * n, pa.int32())],
                    names=[f.name for f in KAFKA_RECORD.fields])
            at += batch.num_rows


class _Reader:
    def __init__(self, options):
        self.path = options["path"]
        self.topic = options.get("topic", self.path.rstrip("/").rsplit("/", 1)[-1])
        self.start = options.get("startingOffsets", "earliest")
        self.end = options.get("endingOffsets", "latest")
        most = options.get("maxRecordsPerTrigger")
        self.most = int(most) if most else None
        self.progress = options.get("progress")
        if self.most and not self.progress:
            raise ValueError("maxRecordsPerTrigger needs a folder `progress`")

    def _position(self, what: str) -> dict:
        ends = Log(self.path).latest()["ends"]
        if what == "earliest":
            return {p: 0 for p in ends}
        if what == "latest":
            return dict(ends)
        given = {str(p): int(o) for p, o in json.loads(what).items()}
        for p, o in given.items():
            if p not in ends:
                raise ValueError(f"the log has no partition {p}")
            if not 0 <= o <= ends[p]:
                raise ValueError(f"partition {p} holds offsets 0 to {ends[p]}, not {o}")
        return {p: given.get(p, 0) for p in ends}

    def _split(self, start: dict, end: dict) -> list[Segment]:
        return [Segment(self.path, self.topic, s) for s in Log(self.path).segments(start, end)]

    def read(self, partition):
        yield from _records(partition)


class BatchReader(_Reader, DataSourceReader):
    def partitions(self):
        return self._split(self._position(self.start), self._position(self.end)) or [
            Segment(self.path, self.topic, {})]

    def read(self, partition):
        if partition.entry:
            yield from _records(partition)


class StreamReader(_Reader, DataSourceStreamReader):
    def _planned(self, new: dict | None = None) -> dict | None:
        """What the query has planned up to, in the folder ``progress``."""
        if not self.progress:
            return None
        system, root = file_system(self.progress.rstrip("/"))
        name = f"{root}/planned.json"
        if new is not None:
            system.create_dir(root, recursive=True)
            with system.open_output_stream(name + ".new") as f:
                f.write(json.dumps(new).encode())
            system.move(name + ".new", name)
            return new
        try:
            with system.open_input_stream(name) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def initialOffset(self) -> dict:
        start = self._position(self.start)
        if self.most:
            self._planned(start)
        return start

    def latestOffset(self) -> dict:
        ends = Log(self.path).latest()["ends"]
        if not self.most:
            return dict(ends)
        at, left = self._planned() or {}, self.most
        out = {}
        for p, e in sorted(ends.items(), key=lambda x: x[1] - at.get(x[0], 0)):
            # Partitions share the bound evenly; what a short one leaves goes on.
            share = left // (len(ends) - len(out))
            out[p] = min(e, at.get(p, 0) + max(share, 0))
            left -= out[p] - at.get(p, 0)
        return out

    def partitions(self, start: dict, end: dict):
        if self.most:
            known = self._planned() or {}
            self._planned({p: max(e, known.get(p, 0)) for p, e in end.items()})
        return self._split(start, end)


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return KAFKA_RECORD

    def reader(self, schema):
        return BatchReader(self.options)

    def streamReader(self, schema):
        return StreamReader(self.options)

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("a log is only ever added to")
        return BatchWriter(self.options, schema)

    def streamWriter(self, schema, overwrite: bool):
        return StreamWriter(self.options, schema)


# --- for users ----------------------------------------------------------------

def _offsets(position: str | dict) -> str:
    return position if isinstance(position, str) else json.dumps(
        {str(p): int(o) for p, o in position.items()})


def log_source(spark: SparkSession, path: str, *, starting_offsets: str | dict = "earliest",
               max_records_per_trigger: int | None = None,
               progress: str | None = None) -> DataFrame:
    """The log as a stream of records of the shape a Kafka source yields."""
    spark.dataSource.register(RecordLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option(
        "startingOffsets", _offsets(starting_offsets))
    if max_records_per_trigger:
        reader = reader.option("maxRecordsPerTrigger", str(max_records_per_trigger))
    if progress:
        reader = reader.option("progress", progress)
    return reader.load()


def read_log(spark: SparkSession, path: str, *, starting_offsets: str | dict = "earliest",
             ending_offsets: str | dict = "latest") -> DataFrame:
    """The records of the log from one position to before another."""
    spark.dataSource.register(RecordLog)
    return (spark.read.format(FORMAT).option("path", path)
            .option("startingOffsets", _offsets(starting_offsets))
            .option("endingOffsets", _offsets(ending_offsets)).load())


def append_log(df: DataFrame, path: str, partitions: int = 1) -> None:
    """Add the records of ``df`` (``value`` and, if there is one, ``key``) to the log."""
    df.sparkSession.dataSource.register(RecordLog)
    names = [c for c in ("key", "value") if c in df.columns]
    df.select(*names).write.format(FORMAT).mode("append").option("path", path).option(
        "partitions", str(partitions)).save()


def stream_log(df: DataFrame, path: str, checkpoint: str, *, writer: str, partitions: int = 1,
               trigger: str | None = None) -> StreamingQuery:
    """Stream records into the log; ``writer`` names the query for good (its batches
    count once, also after a restart)."""
    df.sparkSession.dataSource.register(RecordLog)
    names = [c for c in ("key", "value") if c in df.columns]
    w = (df.select(*names).writeStream.format(FORMAT).option("path", path)
         .option("partitions", str(partitions)).option("writer", writer)
         .option("checkpointLocation", checkpoint))
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
