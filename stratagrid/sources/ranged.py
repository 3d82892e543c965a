"""Framed messages read by byte ranges, as a data source: one large file is many tasks.

A message begins with a magic, has its length in bytes 8 to 15 and ends with a trailer.
It belongs to the range in which it begins. A range's task finds its first message by
the magic, and takes it only if its end has the trailer and the file ends there or goes
on with another magic; from there it follows the lengths. Headers and trailers are read,
contents aren't. Paths are what pyarrow's file systems open (local or shared folders,
object stores). Small ranges share a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "file string, span long, place long, start long, length long, discipline long, error string"
#: Bytes of a range, and of a look for the next magic.
RANGE, LOOK = 64 << 20, 1 << 16
HEAD = 16
#: Small ranges share a task, up to these bytes, if that leaves as many tasks at least.
TASK, TASKS = 32 << 20, 64
#: Rows of a batch.
BATCH = 10_000
COLUMNS = pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("span", "place", "start", "length", "discipline")), ("error", pa.string())])


class Ranges(InputPartition):
    """Ranges of a task: (file, size, first range, range behind the last) for each file."""

    def __init__(self, number: int, pieces: list[tuple[str, int, int, int]]):
        super().__init__(number)
        self.pieces = pieces


class Bytes:
    """A file read by places, with a look ahead while messages are small."""

    def __init__(self, f, size: int):
        self.f, self.size, self.at, self.seen, self.ahead = f, size, 0, b"", LOOK

    def get(self, at: int, n: int, least: int = 0) -> bytes:
        i = at - self.at
        if i < 0 or i + n > len(self.seen) and at + n > self.at + len(self.seen) < self.size:
            self.f.seek(at)
            self.at, self.seen, i = at, self.f.read(max(n, least, self.ahead)), 0
        return self.seen[i : i + n]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path
    return fs.FileSystem.from_uri(path)


class FramedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.magic, self.trailer = options.get("magic", "GRIB").encode(), options.get("trailer", "7777").encode()
        self.bytes = int(options.get("rangebytes", RANGE))
        self.only: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality of `file` leaves other files unread; the rest is Spark's."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("file",) or isinstance(f, In) and f.attribute == ("file",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = named if self.only is None else self.only & named
            else:
                yield f

    def partitions(self) -> list[Ranges]:
        system, root = _opened(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))
        files = [(p, n, -(-n // self.bytes)) for p, n in files if self.only is None or p in self.only]
        each = max(1, min(TASK // self.bytes, sum(k for _, _, k in files) // TASKS))
        tasks: list[Ranges] = []
        left = 0
        for path, size, k in files:
            at = 0
            while at < k:
                if not left:
                    tasks.append(Ranges(len(tasks), []))
                    left = each
                n = min(left, k - at)
                tasks[-1].pieces.append((path, size, at, at + n))
                at, left = at + n, left - n
        return tasks

    def _size(self, b: Bytes, at: int) -> int | None:
        """The length of the whole message that starts at `at`; 0 if it has no end, None if none starts there."""
        head, end = b.get(at, HEAD), len(self.trailer)
        if len(head) < HEAD or not head.startswith(self.magic):
            return None
        n = int.from_bytes(head[8:16], "big")
        if n < HEAD + end or at + n > b.size:
            return 0
        b.ahead = LOOK if n < LOOK // 4 else 0
        return n if b.get(at + n - end, end, end + HEAD) == self.trailer else 0

    def _follows(self, b: Bytes, at: int) -> bool:
        return at == b.size or b.get(at, len(self.magic)) == self.magic

    def _first(self, b: Bytes, start: int, stop: int) -> int | None:
        """Where the first whole message of a range begins, that another or the end of the file follows."""
        at = start
        while at < stop:
            seen = b.get(at, min(LOOK, stop - at) + len(self.magic) - 1)
            i = seen.find(self.magic)
            while i >= 0:
                n = self._size(b, at + i)
                if n and self._follows(b, at + i + n):
                    return at + i
                i = seen.find(self.magic, i + 1)
            at += LOOK
        return None

    def _rows(self, f, path: str, size: int, first: int, last: int) -> Iterator[tuple]:
        """The messages of the ranges `first` to `last` (exclusive) of a file, each range as if it were alone."""
        b = Bytes(f, size)
        for span in range(first, last):
            stop, place = min((span + 1) * self.bytes, size), 0
            at = 0 if span == 0 else self._first(b, span * self.bytes, stop)
            while at is not None and at < stop:
                n = self._size(b, at)
                if not n:
                    yield path, span, place, at, None, None, "no message starts here" if n is None else "the message has no end"
                    break
                yield path, span, place, at, n, b.get(at + 6, 1)[0], None
                at, place = at + n, place + 1

    def read(self, task: Ranges) -> Iterator[pa.RecordBatch]:
        for file, size, first, last in task.pieces:
            system, path = _opened(file)
            with system.open_input_file(path) as f:
                rows = self._rows(f, file, size, first, last)
                while some := list(islice(rows, BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), COLUMNS.types)], schema=COLUMNS)


class FramedMessages(DataSource):
    """Options: path, rangeBytes, magic, trailer."""

    @classmethod
    def name(cls) -> str:
        return "framed_messages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FramedReader:
        return FramedReader(dict(self.options))


def message_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """(file, span, place, start, length, discipline, error) of framed files: `place` counts the messages of a range, `span` the ranges of a file.

    Where a range doesn't go on with a whole message, a row says so in `error`; its rest
    is left, and the next range begins with the first message it finds.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FramedMessages)
    return spark.read.format("framed_messages").option("rangeBytes", str(range_bytes)).load(path)


def numbered(messages: DataFrame) -> DataFrame:
    """`messages` of `message_ranges` with `message`, the number in the file: counts of the ranges before are added."""
    counts = messages.groupBy("file", "span").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range of a file
    offsets = counts.select("file", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    j = messages.join(offsets, ["file", "span"])
    return j.select("file", (F.col("before") + F.col("place")).alias("message"), "start", "length", "discipline", "error")
