"""Versions of a folder: small JSON documents that name the files which count.

Data files are written first, under names that are new for every attempt, and
become visible only through the next version. A version is written aside and then
renamed to its number, which fails if another writer took that number first; so of
two writers one wins, the other looks at what the winner did and tries again, and
a reader that holds a version sees one state however long it reads. A job that
dies before its rename leaves files that no version names.

Uses Hadoop's ``FileContext``, so any file system that Spark writes to will do whose
rename is atomic and refuses to overwrite.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_FOLDER = "_versions"
_NAME = re.compile(r"^v(\d{12})\.json$")


class Taken(Exception):
    """Another writer has made that version."""


class Versions:
    """The versions of the folder ``root`` (1, 2, 3...; 0: there is none yet)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._hadoop = self._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        path = self._hadoop.Path(f"{self.root}/{_FOLDER}")
        self._folder = path.getFileSystem(conf).makeQualified(path)
        self._context = self._hadoop.FileContext.getFileContext(self._folder.toUri(), conf)

    def _path(self, name: str):
        return self._hadoop.Path(self._folder, name)

    def numbers(self) -> list[int]:
        """The versions that can be read, oldest first."""
        if not self._context.util().exists(self._folder):
            return []
        found = self._context.util().listStatus(self._folder)
        names = (_NAME.match(s.getPath().getName()) for s in found)
        return sorted(int(m[1]) for m in names if m)

    def latest(self) -> tuple[int, dict]:
        """(number, document) of the newest version; (0, {}) without any."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def read(self, number: int) -> dict:
        stream = self._context.open(self._path(f"v{number:012d}.json"))
        try:
            utf8 = self._jvm.java.nio.charset.StandardCharsets.UTF_8
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, utf8))
        finally:
            stream.close()

    def commit(self, number: int, document: dict) -> None:
        """Make ``document`` the version ``number`` (the latest one's plus 1), or
        raise :class:`Taken`."""
        flags = self._jvm.java.util.EnumSet.of(
            getattr(self._hadoop, "CreateFlag").CREATE)
        gateway = self.spark.sparkContext._gateway
        create = gateway.new_array(getattr(self._hadoop, "Options$CreateOpts"), 1)
        create[0] = getattr(self._hadoop, "Options$CreateOpts").createParent()
        aside = self._path(f".{uuid.uuid4().hex}.tmp")
        stream = self._context.create(aside, flags, create)
        try:
            stream.write(bytearray(json.dumps(document).encode()))
        finally:
            stream.close()
        from py4j.protocol import Py4JJavaError

        try:
            self._context.rename(aside, self._path(f"v{number:012d}.json"), gateway.new_array(
                getattr(self._hadoop, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            self._context.delete(aside, False)
            raise Taken(number) from e

    def change(self, step, tries: int = 20) -> tuple[int, dict]:
        """Commit ``step(latest document)``; again on what another writer made of it,
        should one come in between. ``step`` returns None to leave all as it is."""
        for _ in range(tries):
            number, document = self.latest()
            new = step(document)
            if new is None:
                return number, document
            try:
                self.commit(number + 1, new)
                return number + 1, new
            except Taken:
                continue
        raise Taken(f"no version of {self.root} could be made in {tries} tries")
