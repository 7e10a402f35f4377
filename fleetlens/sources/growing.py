"""Growing event logs as a streaming source: every whole line once, while applications still write.

Spark's file source reads a file once, when it first lists it.  This source
keeps a byte offset per log file: a micro-batch holds the lines between two
offsets, which always lie behind a line's end, so a line that is only half
written waits for the next batch.  Offsets are in the query's checkpoint, so a
restart goes on where the last batch ended.

A file keeps its offset when its writer drops the ``.inprogress`` suffix.
Large stretches are cut in splits of SPLIT bytes; a split owns the lines that
begin in it.  Logs must be written without compression
(``spark.eventLog.compress=false``): a compressed one is refused by name.
Paths can be of any store ``pyarrow.fs`` opens, on the driver and the executors
alike.  The offsets' size grows with the number of files in the folder, some 50
bytes each; finished logs can be moved away once they have been read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT = 64 << 20
CHUNK = 1 << 20
SUFFIX = ".inprogress"
COMPRESSED = re.compile(r"\.(zstd|zst|lz4|lzf|snappy|gz)$")
SCHEMA = "log string, value string"


def log_of(name: str) -> str:
    """Name of the log a file belongs to, as :func:`fleetlens.sources.eventlog.log_name` has it."""
    rolled = re.search(r"eventlog_v2_([^/]+)/events_[^/]*$", name)
    return rolled.group(1) if rolled else name.rsplit("/", 1)[-1]


@dataclass
class Stretch(InputPartition):
    """Bytes [start, end) of a file; the split reads the lines that begin there.  ``last`` is the stretch's end."""

    name: str
    start: int
    end: int
    first: int
    last: int


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, path: str, split: int = SPLIT):
        self.path = path
        self.split = split

    def _open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """For every log file the position behind its last whole line."""
        store, root = self._open()
        out = {}
        for info in store.get_file_info(pafs.FileSelector(root, recursive=True)):
            name = info.path[len(root) :].lstrip("/").removesuffix(SUFFIX)
            base = name.rsplit("/", 1)[-1]
            if not info.is_file or base.startswith((".", "_", "appstatus_")):
                continue
            if COMPRESSED.search(name):
                raise ValueError(f"a compressed event log cannot be followed: {info.path}")
            out[name] = self._whole_lines(store, info.path, info.size)
        return out

    @staticmethod
    def _whole_lines(store: pafs.FileSystem, path: str, size: int) -> int:
        with store.open_input_file(path) as file:
            end = size
            while end > 0:
                start = max(0, end - CHUNK)
                at = file.read_at(end - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                end = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for name, last in sorted(end.items()):
            first = start.get(name, 0)
            out += [Stretch(name, a, min(a + self.split, last), first, last) for a in range(first, last, self.split)]
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        store, root = self._open()
        path = f"{root}/{partition.name}"
        if store.get_file_info(path + SUFFIX).is_file:
            path += SUFFIX
        log = log_of(partition.name)
        with store.open_input_file(path) as file:
            # a line belongs to the split its first byte is in: skip the one begun before this split
            at = partition.start if partition.start == partition.first else self._next_line(file, partition.start - 1, partition.last)
            rest = b""
            while at + len(rest) < partition.last and at < partition.end:
                block = file.read_at(min(CHUNK, partition.last - at - len(rest)), at + len(rest))
                if not block:
                    raise OSError(f"{path} is shorter than it was: {at + len(rest)} of {partition.last} bytes")
                held = rest + block
                lines, begins = [], at
                while (stop := held.find(b"\n", begins - at)) >= 0 and begins < partition.end:
                    lines.append(held[begins - at : stop].decode("utf-8", "replace"))
                    begins = at + stop + 1
                rest, at = held[begins - at :], begins
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array([log] * len(lines)), pa.array(lines)], names=["log", "value"])

    @staticmethod
    def _next_line(file: pa.NativeFile, at: int, last: int) -> int:
        """The first position behind a line's end from byte ``at`` on."""
        while at < last:
            block = file.read_at(min(CHUNK, last - at), at)
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(block)
        return last


class GrowingLogs(DataSource):
    """``spark.readStream.format("growing_logs").load(folder)``: (log, value) lines of growing event logs."""

    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingLogReader:
        return GrowingLogReader(self.options["path"], int(self.options.get("splitBytes", SPLIT)))
