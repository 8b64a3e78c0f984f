"""Following a rotated log as a stream (SRC-08, SRC-09, SORT-03).

Spark's own file source reads complete files.  This source reads the lines that are appended to a
log since the last batch, in the growing file and in the segments that it is rotated to.  It is a
Python streaming data source: the offset is, for each segment, the byte up to which its lines have been
taken, so a restart from a checkpoint goes on at the byte where it stopped.

A segment is known by the digest of its first line, not by its name: when ``app.log`` becomes
``app.log-20240102`` it goes on as the same segment, and the new ``app.log`` is another one.  Two segments
that begin with the same line are told apart by their place in time (the n-th of that line, oldest
first).  A line counts when its end is there; the last line of a segment that isn't the newest needs no line
end.  A batch's bytes are cut into ranges that executors read on their own; a range has the
lines that begin in it.  The folder must be one that all executors see.

    spark.dataSource.register(LogFollower)
    spark.readStream.format("log_follow").option("path", folder).option("name", "app.log").load()
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("segment", StringType()), StructField("offset", LongType()), StructField("line", StringType())])
#: Bytes of one range and rows of one batch that a task hands over.
RANGE = 64 << 20
ROWS = 10_000


class Range(InputPartition):
    def __init__(self, segment: str, begin: int, start: int, end: int):
        self.segment, self.begin, self.start, self.end = segment, begin, start, end


def segment_date(name: str, log: str) -> str | None:
    """The date of a rotated segment ``<log>-YYYYMMDD``, '' for the log itself, None for another file."""
    if name == log:
        return ""
    m = re.fullmatch(re.escape(log) + r"-(\d{8})", name)
    return m[1] if m else None


def segments(folder: str, log: str) -> list[tuple[str, str]]:
    """(id, path) of the log's segments, oldest first; the growing file is the last."""
    dated = [(d == "", d, n) for n in (os.listdir(folder) if os.path.isdir(folder) else []) if (d := segment_date(n, log)) is not None]
    out, times = [], {}
    for _, _, name in sorted(dated):
        path = os.path.join(folder, name)
        try:
            with open(path, "rb") as f:
                head = f.readline()
        except FileNotFoundError:
            continue  # rotated just now; the next listing has it
        if not head or (name == log and not head.endswith(b"\n")):
            continue  # no complete line yet
        digest = hashlib.sha1(head).hexdigest()
        times[digest] = times.get(digest, 0) + 1
        out.append((f"{digest}.{times[digest]}", path))
    return out


def complete(path: str, last: bool) -> int:
    """Bytes of a segment up to the end of its last complete line; all of it unless it is the ``last`` segment."""
    with open(path, "rb") as f:
        size = f.seek(0, os.SEEK_END)
        if not last:
            return size
        at = size
        while at:
            step = min(1 << 16, at)
            f.seek(at - step)
            cut = f.read(step).rfind(b"\n")
            if cut >= 0:
                return at - step + cut + 1
            at -= step
        return 0


class LogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.log = options["path"], options["name"]
        self.range = int(options.get("bytesperrange", RANGE))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = segments(self.folder, self.log)
        return {s: complete(p, k == len(found) - 1) for k, (s, p) in enumerate(found)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for s, stop in end.items():
            begin = int(start.get(s, 0))
            out += [Range(s, begin, at, min(at + self.range, stop)) for at in range(begin, stop, self.range)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        path = dict(segments(self.folder, self.log)).get(partition.segment)
        if path is None:
            raise FileNotFoundError(f"segment {partition.segment} of {self.log} is gone before its lines were read")
        offsets, lines = [], []
        with open(path, "rb") as f:
            f.seek(partition.start)
            if partition.start > partition.begin:  # the line that runs into this range belongs to the one before
                f.seek(partition.start - 1)
                f.readline()
            at = f.tell()
            while at < partition.end:
                line = f.readline()
                if not line:
                    break
                offsets.append(at)
                lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                at += len(line)
                if len(lines) == ROWS:
                    yield self._batch(partition.segment, offsets, lines)
                    offsets, lines = [], []
        if lines:
            yield self._batch(partition.segment, offsets, lines)

    @staticmethod
    def _batch(segment: str, offsets: list[int], lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([segment] * len(lines)), pa.array(offsets, pa.int64()), pa.array(lines, pa.string())], SCHEMA.names)

    def commit(self, end: dict) -> None:
        pass


class LogFollower(DataSource):
    """Options: path (folder), name (of the growing file), bytesPerRange."""

    @classmethod
    def name(cls) -> str:
        return "log_follow"

    def schema(self) -> StructType:
        return SCHEMA

    def streamReader(self, schema: StructType) -> LogStream:
        return LogStream({k.lower(): v for k, v in self.options.items()})
