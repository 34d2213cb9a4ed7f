"""``sse_capture``: server-sent-event captures as a Spark data source, batch and streaming.

:mod:`pulse.sources.capture` frames a table of lines, file by file. This source
reads the rotated files of a capture as the one byte sequence they are, so an
event that was cut by a rotation (between two lines or inside one) is whole
again. The framing rules are the same.

A capture is a directory; its files follow each other in name order and only
grow at the end. The byte sequence is planned in ranges of ``splitbytes``
(default 64 MB), one input partition each, whatever the files' sizes. A range
owns the events that begin after its first blank line and reads on until the
first blank line of the next range, so neighbours agree without looking back.

A streaming offset is the place after the last blank line that a capture had
when the micro-batch was planned: ranges read again give the same events, and an
unfinished event waits for its end.

Files are opened by pyarrow (local or shared paths, HDFS, S3, GCS), on the
driver only to list them and to find the last blank line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from pulse.operators.parse import is_valid_json

NAME = "sse_capture"
SCHEMA = "capture string, file string, position long, value string, sse_event string, sse_id string"
SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20        # read at a time
ROWS = 4096                 # events of an Arrow batch

Files = list[tuple[str, int]]       # (name, bytes) in order


def _is_capture(info: pafs.FileInfo) -> bool:
    return info.type == pafs.FileType.File and not info.base_name.startswith(("_", "."))


def captures(path: str) -> tuple[pafs.FileSystem, dict[str, Files]]:
    """The directories under ``path`` (itself included) that hold files, by path, with their files in name order."""
    filesystem, base = pafs.FileSystem.from_uri(path)
    found: dict[str, Files] = {}
    for info in filesystem.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
        if _is_capture(info):
            found.setdefault(info.path.rsplit("/", 1)[0], []).append((info.base_name, info.size))
    return filesystem, {c: sorted(files) for c, files in sorted(found.items())}


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a capture's sequence (which begins with ``files[0]``); events are read up to ``stop``."""
    path: str
    capture: str
    files: Files
    start: int
    end: int
    stop: int
    at_event: bool      # does an event begin at ``start``?
    more: bool = False  # do files follow that are listed only if an event goes on so far?


def ranges(path: str, capture: str, files: Files, start: int, stop: int, split_bytes: int) -> list[Range]:
    """The ranges of [start, stop); each carries its own files and the one after them."""
    out, before, keep = [], 0, 0
    for at in range(start, stop, split_bytes):
        while keep < len(files) - 1 and before + files[keep][1] < at:       # keeps the byte before ``at``
            before += files[keep][1]
            keep += 1
        end = min(at + split_bytes, stop)
        to, held = keep, before
        while to < len(files) and held < end:
            held += files[to][1]
            to += 1
        out.append(Range(path, capture, files[keep:to + 1], at - before, end - before, stop - before, at == start, to + 1 < len(files)))
    return out


def _files(filesystem: pafs.FileSystem, r: Range) -> Iterator[tuple[str, int]]:
    """The files of a range, then those that follow them."""
    yield from r.files
    if r.more:
        found = filesystem.get_file_info(pafs.FileSelector(r.capture))
        yield from sorted((i.base_name, i.size) for i in found if _is_capture(i) and i.base_name > r.files[-1][0])


def _blocks(filesystem: pafs.FileSystem, r: Range, start: int) -> Iterator[bytes]:
    """The bytes of the sequence from ``start`` to ``r.stop``."""
    at = 0
    for name, size in _files(filesystem, r):
        lo, hi = max(start - at, 0), min(r.stop - at, size)
        if lo < hi:
            with filesystem.open_input_file(f"{r.capture}/{name}") as f:
                f.seek(lo)
                while lo < hi:
                    block = f.read(min(READ_BYTES, hi - lo))
                    if not block:
                        raise OSError(f"{name} has become shorter")
                    lo += len(block)
                    yield block
        at += size
        if at >= r.stop:
            return


def _place(filesystem: pafs.FileSystem, r: Range, position: int) -> tuple[str, int]:
    """The file that holds the byte at ``position``, and the byte's place in it."""
    for name, size in _files(filesystem, r):
        if position < size:
            return name, position
        position -= size
    raise OSError(f"{r.capture} has become shorter")


def _lines(filesystem: pafs.FileSystem, r: Range) -> Iterator[tuple[int, int, str]]:
    """(position, next line's position, stripped text) of the lines that begin in [start, stop) and end before ``stop`` with a line break."""
    first = r.start if r.at_event or r.start == 0 else r.start - 1
    at, rest, skip = first, [], first < r.start        # the byte before the range tells whether a line begins with it
    for block in _blocks(filesystem, r, first):
        *whole, tail = block.split(b"\n")
        for line in whole:
            if rest:
                rest.append(line)
                line = b"".join(rest)
                rest = []
            after = at + len(line) + 1
            if not skip:
                yield at, after, line.decode("utf-8", "replace").strip()
            skip, at = False, after
        if tail:
            rest.append(tail)


def events(filesystem: pafs.FileSystem, r: Range) -> Iterator[tuple[int, str, str | None, str | None]]:
    """(position, value, sse_event, sse_id) of the terminated events that the range owns."""
    begin, data, event, ident, owned = None, [], None, None, r.at_event
    for at, _, line in _lines(filesystem, r):
        if line:
            if owned:
                begin = at if begin is None else begin
                if line.startswith("data:"):
                    part = line[5:].strip()
                    if part:
                        data.append(part)
                elif line.startswith("event:"):
                    event = line[6:].strip()
                elif line.startswith("id:"):
                    ident = line[3:].strip()
            continue
        value = "\n".join(data).strip()
        if value:
            yield begin, value, event, ident
        begin, data, event, ident, owned = None, [], None, None, True
        if at >= r.end:
            return


def read_range(r: Range | None) -> Iterator[pa.RecordBatch]:
    if r is None:           # Spark's one partition of a plan without any
        return
    filesystem, _ = pafs.FileSystem.from_uri(r.path)
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows))
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["capture", "file", "position", "value", "sse_event", "sse_id"])

    for position, *rest in events(filesystem, r):
        rows.append((r.capture, *_place(filesystem, r, position), *rest))
        if len(rows) == ROWS:
            yield batch()
            rows = []
    if rows:
        yield batch()


class _Options:
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("sse_capture needs a path")
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        if self.split_bytes < 1:
            raise ValueError("splitbytes is positive")


class CaptureReader(_Options, DataSourceReader):
    def partitions(self) -> list[Range]:
        _, found = captures(self.path)
        return [r for c, files in found.items() for r in ranges(self.path, c, files, 0, sum(n for _, n in files), self.split_bytes)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        return read_range(partition)


def last_boundary(filesystem: pafs.FileSystem, path: str, capture: str, files: Files) -> int:
    """The place after the last blank line of the sequence (0 if there is none), read from the end backwards."""
    total = sum(n for _, n in files)
    width = 1 << 12
    while True:
        lo = max(total - width, 0)
        r = Range(path, capture, files, lo, total, total, lo == 0)
        found = [after for _, after, line in _lines(filesystem, r) if not line]
        if found or lo == 0:
            return found[-1] if found else 0
        width *= 8


class CaptureStreamReader(_Options, DataSourceStreamReader):
    """Offsets: {capture: [file, byte]}, one entry per capture directory."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self, *args) -> dict:
        filesystem, found = captures(self.path)
        out = {}
        for capture, files in found.items():
            at = last_boundary(filesystem, self.path, capture, files)
            for name, size in files:
                if at <= size:
                    out[capture] = [name, at]
                    break
                at -= size
        return out

    def partitions(self, start: dict, end: dict) -> list[Range]:
        _, found = captures(self.path)
        out = []
        for capture, (name, byte) in end.items():
            files = [f for f in found.get(capture, []) if f[0] <= name]
            if not files or files[-1][0] != name:
                raise OSError(f"{capture}/{name} is gone")
            first = start.get(capture)
            if first is not None:
                files = [f for f in files if f[0] >= first[0]]
            stop = sum(n for _, n in files[:-1]) + byte
            out += ranges(self.path, capture, files, first[1] if first is not None else 0, stop, self.split_bytes)
        return out

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        return read_range(partition)

    def commit(self, end: dict) -> None:
        pass


class CaptureSource(DataSource):
    """``spark.read.format("sse_capture")`` and ``readStream``; options ``path`` and ``splitbytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(self.options)

    def streamReader(self, schema) -> CaptureStreamReader:
        return CaptureStreamReader(self.options)


def capture_source(spark: SparkSession, path: str, streaming: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Events of the captures under ``path``: ``capture, file, position, value, sse_event, sse_id, is_valid``.

    (file, position) is where the event's first line begins. An event whose
    blank line is not there yet is left out (a stream gives it later); empty
    files, captures without an event and an empty directory give no rows.
    """
    spark.dataSource.register(CaptureSource)
    reader = spark.readStream if streaming else spark.read
    rows = reader.format(NAME).option("path", path).option("splitbytes", str(split_bytes)).load()
    return rows.withColumn("is_valid", F.coalesce(is_valid_json("value"), F.lit(False)))
