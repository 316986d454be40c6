"""Append-only ledgers of JSON lines as a data source of Spark: committed files, byte ranges, line numbers.

``df.write.format("auditloom-ledger").mode("append").save(path)`` writes a file per task
attempt and then, in the driver, one manifest that names the files of the attempts that
counted. A reader takes files from manifests alone, so what a failed, repeated or speculative
attempt has left is never seen, and an append is there whole or not at all. A manifest also
says where in a file lines begin, every ``STEP`` bytes: a reader splits files there and knows
the number of every line without reading those before it.

``spark.read.format("auditloom-ledger").load(path)`` gives ``append, file, line_no, value``:
``append`` numbers the appends, ``line_no`` the lines of a file from 0, ``value`` is the line;
``parse_ndjson`` of ``sources.tables`` makes fields of it. An empty frame appends nothing to
read; a path without manifests is an empty ledger; a null row value is ``{}``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "auditloom-ledger"
SCHEMA = "append long, file string, line_no long, value string"
#: Bytes between the places that a manifest notes.
STEP = 4 << 20
#: Lines of an Arrow batch.
BATCH = 4096


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _plain(x):
    """What JSON has no name for, as text."""
    if isinstance(x, (date, datetime)):
        return x.isoformat()
    if isinstance(x, Decimal):
        return str(x)
    if isinstance(x, (bytes, bytearray)):
        return bytes(x).hex()
    raise TypeError(f"no JSON for {type(x).__name__}")


@dataclass
class Written(WriterCommitMessage):
    """A task attempt's file: its lines, its bytes, and the noted places as (byte, line)."""

    file: str
    lines: int
    size: int
    places: list[tuple[int, int]]


@dataclass
class Range(InputPartition):
    append: int
    file: str
    start: int
    end: int
    line: int


class LedgerWriter(DataSourceWriter):
    def __init__(self, path: str, step: int) -> None:
        self.path, self.step = path, step

    def write(self, rows: Iterator) -> Written:
        where, root = _open(self.path)
        where.create_dir(f"{root}/lines", recursive=True)
        name = f"{uuid.uuid4().hex}.ndjson"
        lines, size, places = 0, 0, [(0, 0)]
        with where.open_output_stream(f"{root}/lines/{name}", compression=None) as out:
            for row in rows:
                line = json.dumps(row.asDict(True), default=_plain, ensure_ascii=False).encode("utf-8", "surrogatepass") + b"\n"
                if size - places[-1][0] >= self.step:
                    places.append((size, lines))
                out.write(line)
                lines, size = lines + 1, size + len(line)
        return Written(name, lines, size, places)

    def commit(self, messages: list[Written | None]) -> None:
        """One manifest, moved into place whole; appends that meet get one number and differ by name, so neither is lost."""
        where, root = _open(self.path)
        folder = f"{root}/manifests"
        where.create_dir(folder, recursive=True)
        taken = [int(f.base_name.split("-")[0]) for f in where.get_file_info(fs.FileSelector(folder)) if f.base_name.endswith(".json")]
        files = [{"file": m.file, "lines": m.lines, "size": m.size, "places": m.places} for m in messages if m is not None and m.lines]
        name = uuid.uuid4().hex
        own = f"{folder}/{name}.part"
        with where.open_output_stream(own, compression=None) as out:
            out.write(json.dumps({"files": files}).encode())
        where.move(own, f"{folder}/{max(taken, default=-1) + 1:012d}-{name}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Files of an append that failed go; those of attempts that gave no message stay unseen."""
        where, root = _open(self.path)
        for m in messages:
            if m is not None:
                where.delete_file(f"{root}/lines/{m.file}")


class LedgerReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Range]:
        where, root = _open(self.path)
        out = []
        folder = fs.FileSelector(f"{root}/manifests", allow_not_found=True)
        manifests = sorted((f for f in where.get_file_info(folder) if f.base_name.endswith(".json")), key=lambda f: f.base_name)
        for append, found in enumerate(manifests):
            with where.open_input_stream(found.path) as f:
                said = json.loads(f.read())
            for file in said["files"]:
                ends = [*[p[0] for p in file["places"][1:]], file["size"]]
                out += [Range(append, file["file"], at, end, line) for (at, line), end in zip(file["places"], ends, strict=True)]
        return out or [Range(-1, "", 0, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part.append < 0:
            return
        where, root = _open(self.path)
        schema = pa.schema([("append", pa.int64()), ("file", pa.string()), ("line_no", pa.int64()), ("value", pa.string())])
        with where.open_input_file(f"{root}/lines/{part.file}") as f:
            f.seek(part.start)
            lines = f.read(part.end - part.start).decode("utf-8", "replace").split("\n")[:-1]
        for at in range(0, len(lines), BATCH):
            some = lines[at : at + BATCH]
            n = len(some)
            yield pa.RecordBatch.from_arrays([pa.array([part.append] * n, pa.int64()), pa.array([part.file] * n), pa.array(range(part.line + at, part.line + at + n), pa.int64()), pa.array(some)], schema=schema)


class LedgerSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return LedgerReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a ledger is only appended to")
        return LedgerWriter(self.options["path"], int(self.options.get("step", STEP)))


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    spark.dataSource.register(LedgerSource)
