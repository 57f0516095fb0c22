"""FASTQ files as a data source: partitions are ranges of bytes that begin at a record, so no line is shuffled."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, of a read from a file, and records of a batch.
PART_BYTES = 64 << 20
_READ = 4 << 20
#: Ranges are tasks of their own up to so many; beyond, a task reads several one after the other, of so many bytes at most. What a gzipped byte counts as.
_TASKS, _TASK_BYTES, _UNPACKED = 64, 64 << 20, 5
_BATCH = 16_384
#: Names of files that are read of a folder: also those that Spark's text sink gives.
_NAME = re.compile(r"\.(?:fq|fastq|txt)(\.gz)?$")
_SCHEMA = pa.schema([("file", pa.string()), ("part", pa.int32()), ("row", pa.int64()), ("read_id", pa.string()), ("seq", pa.string()), ("qual", pa.string())])
_FORMAT = "weftline_fastq"


@dataclass
class _Range:
    path: str
    label: str
    part: int
    start: int
    end: int | None  # None: to the end, gzipped


@dataclass
class _Ranges(InputPartition):
    ranges: list[_Range]


def _store(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", path))
    return fs.LocalFileSystem(), path


def _blocks(file, packed: bool, size: int = _READ) -> Iterator[bytes]:
    """Bytes of an open file from where it stands; a gzipped file may have several members."""
    unpack = zlib.decompressobj(31) if packed else None
    while block := file.read(size):
        while unpack and block:
            yield unpack.decompress(block)
            block = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)
        if not packed:
            yield block


def _lines(file, start: int, packed: bool, size: int = _READ) -> Iterator[tuple[int, bytes]]:
    """Lines that begin at ``start`` or later, with their offsets."""
    at, rest, skip = start, b"", start > 0
    if skip:
        at -= 1
        file.seek(at)
    for block in _blocks(file, packed, size):
        lines = (rest + block).split(b"\n")
        rest = lines.pop()
        for line in lines:
            if not skip:
                yield at, line.removesuffix(b"\r")
            skip = False
            at += len(line) + 1
    if rest and not skip:
        yield at, rest.removesuffix(b"\r")


def records(file, start: int, end: int | None, packed: bool) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Headers, sequences and qualities of the records that begin in a range.

    A line that begins with @ is a header if the second after it begins with +: after a quality's line that is a sequence. A
    record of fewer than four lines ends a file; a record of another form is an error."""
    lines = _lines(file, start, packed, _READ if end is None else min(_READ, max(1 << 14, end - start)))
    held: list[tuple[int, bytes]] = []
    if start:
        for line in lines:
            held.append(line)
            if len(held) >= 3 and held[-3][1].startswith(b"@") and held[-1][1].startswith(b"+"):
                held = held[-3:]
                break
        else:
            return
    while True:
        while len(held) < 4 and (line := next(lines, None)) is not None:
            held.append(line)
        if len(held) < 4 or (end is not None and held[0][0] >= end):
            return
        (at, header), (_, seq), (_, plus), (_, qual) = held
        if not (header.startswith(b"@") and plus.startswith(b"+")):
            raise ValueError(f"no record at byte {at}")
        yield header, seq, qual
        held = []


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.bytes = options.get("path"), int(options.get("partBytes", PART_BYTES))

    def partitions(self):
        from pyarrow import fs

        store, path = _store(self.path)
        top = store.get_file_info(path)
        files = [top] if top.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        found = []
        for f in sorted(files, key=lambda f: f.path):
            inside = f.path[len(path) :].strip("/").split("/") if f is not top else [f.base_name]
            if f.type != fs.FileType.File or not (f is top or _NAME.search(f.base_name)) or any(x.startswith(("_", ".")) for x in inside):
                continue
            label = "/".join([*(x for x in inside[:-1] if x.startswith(("sample=", "mate="))), f.base_name])
            ranges = [(0, None)] if f.base_name.endswith(".gz") else [(a, min(f.size, a + self.bytes)) for a in range(0, f.size, self.bytes)]
            found += [(f.size * _UNPACKED if b is None else b - a, _Range(f.path, label, k, a, b)) for k, (a, b) in enumerate(ranges)]
        # a task for each of many small ranges would take longer to start than to read
        most = min(_TASK_BYTES, sum(size for size, _ in found) // _TASKS) if len(found) > _TASKS else 0
        out, held = [], 0
        for size, r in found:
            if not out or held + size > most:
                out.append(_Ranges([]))
                held = 0
            out[-1].ranges.append(r)
            held += size
        return out

    def read(self, partition):
        if partition is None:  # no file at all
            return
        store, _ = _store(self.path)
        rows: list[tuple] = []
        for r in partition.ranges:
            with store.open_input_file(r.path) as file:
                for n, (header, seq, qual) in enumerate(records(file, r.start, r.end, r.end is None)):
                    rows.append((r.label, r.part, n, (header[1:].split() or [b""])[0].decode(), seq.decode(), qual.decode()))
                    if len(rows) == _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


class FastqSource(DataSource):
    """``file, part, row, read_id, seq, qual``: ``row`` counts the records of a file's ``part``. Options: ``path`` (a file or a folder
    in a store that pyarrow can open) and ``partBytes``."""

    @classmethod
    def name(cls):
        return _FORMAT

    def schema(self):
        return "file string, part int, row long, read_id string, seq string, qual string"

    def reader(self, schema):
        return FastqReader(self.options)


def fastq(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Records of FASTQ files, gzipped or not, without an exchange. A gzipped file is one partition by its nature."""
    spark.dataSource.register(FastqSource)
    return spark.read.format(_FORMAT).option("partBytes", part_bytes).load(path)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (of :func:`fastq`) with ``ord``, a record's place in its file. What is counted and sent to all tasks is a row for each
    part of a file; the files are read twice, the records stay where they are."""
    counts = rows.groupBy("file", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select("file", "part", F.coalesce(before, F.lit(0)).alias("shift"))
    return rows.join(F.broadcast(shifts), ["file", "part"]).select("file", (F.col("row") + F.col("shift")).alias("ord"), "read_id", "seq", "qual")
