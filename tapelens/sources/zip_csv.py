"""A source for zip archives of CSV members: `spark.read.format("zipcsv")`, `spark.readStream.format("zipcsv")`.

Every row of a member is a row of text. Without a schema, its cells come as a map by column name; with
one, the named columns come as columns of text, and Arrow's CSV reader converts no others. Beside them a schema
may name trade_date, source_file, raw_group, row_num_in_file (from 1, before any rejection), header (the
member's column names), cells, and error, which is set, in a row of its own, where a member cannot be read.

The driver lists the archives and opens none: an input partition is one of an archive's slices, every
k-th of its members by name, and its task reads the archive's directory itself. With the option pushdown,
filters on trade_date prune archives before any is opened, filters on raw_group and source_file prune
members before any is decompressed, and Spark does not repeat them. Spark 4.1 keeps what was pushed with the
loaded table: a query without filters on a DataFrame that was filtered in a query before it would miss
rows. So pushdown is off by default, and `scan` is the way to use it: its filters are part of what it returns.

Nothing is taken from a member that fails. A member is parsed once, into Arrow batches of a bounded
number of rows, which are kept compressed until its end is seen; of a member over HELD_BYTES of them
nothing is kept, and it is parsed a second time. So a task never holds a member.

A row with fewer cells than the header has nulls for the rest; one with more is an error of its member.
Bytes that are not UTF-8 are one too, wherever they are. Blank lines are no rows. A column named twice keeps its
last cell. A member without a header, or with nothing below it, has no rows.

Options: path (a zip, or a folder of zips named YYYYMMDD.zip; a URI of any file system that pyarrow
opens, such as hdfs:// or s3://, else a path that all executors see), slices_per_archive (default 8),
groups (only members of these groups, parted by commas; for streams, to which Spark hands no filters), pushdown (true or
false), log (streams only: a folder, by the same rules, where discovered archives are recorded).
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import re
import zipfile
from collections import deque
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from pathlib import Path, PurePosixPath

import numpy as np
import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import StringType, StructType

SCHEMA = "trade_date date, source_file string, raw_group string, row_num_in_file bigint, cells map<string,string>, error string"
TECHNICAL = {"trade_date": pa.date32(), "source_file": pa.string(), "raw_group": pa.string(), "row_num_in_file": pa.int64(), "header": pa.list_(pa.string()), "cells": pa.map_(pa.string(), pa.string()), "error": pa.string()}
BATCH_ROWS, BLOCK_BYTES, HELD_BYTES = 10_000, 4 << 20, 32 << 20


def original_name(info: zipfile.ZipInfo) -> str:
    """The member's path with forward slashes; names not marked as UTF-8 are read as GBK where that works."""
    name = info.filename
    if not info.flag_bits & 0x800:
        try:
            name = name.encode("cp437").decode("gbk")
        except UnicodeError:
            name = info.filename
    return name.replace("\\", "/")


def archive_date(path: str) -> date | None:
    found = re.search(r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)", PurePosixPath(path).name)
    try:
        return date(*map(int, found.groups())) if found else None
    except ValueError:
        return None


def group_of(name: str, year: int | None) -> str | None:
    """The folder that tells a member's kind: the second part of its path in 2025, else the first."""
    parts = name.split("/")
    at = 1 if year == 2025 else 0
    return parts[at] if len(parts) > at + 1 else None


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or of a local path, and the path in it."""
    return fs.FileSystem.from_uri(path if re.match(r"[a-z0-9+.-]+:", path) else str(Path(path).absolute()))


def archives(path: str) -> list[tuple[str, fs.FileInfo]]:
    """The path itself if it is a file, else all zips below it, each named as a URI or a path like the one given."""
    system, root = located(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(path, info)]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    below = sorted((f for f in found if f.type == fs.FileType.File and f.extension == "zip"), key=lambda f: f.path)
    return [(path.rstrip("/") + f.path.removeprefix(root.rstrip("/")), f) for f in below]


class Stream(io.RawIOBase):
    """A pyarrow file as zipfile wants it: a seek before the start, as in an archive without members, is an OSError."""

    def __init__(self, file: pa.NativeFile):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def readinto(self, into: memoryview) -> int:
        some = self.file.read(len(into))
        into[: len(some)] = some
        return len(some)


@contextmanager
def opened(path: str) -> Iterator[zipfile.ZipFile]:
    system, inside = located(path)
    with system.open_input_file(inside) as file, zipfile.ZipFile(io.BufferedReader(Stream(file))) as z:
        yield z


class Body(io.RawIOBase):
    """What follows a member's header, as a stream for Arrow; `header` is set at once. Bytes that are no UTF-8 raise."""

    def __init__(self, stream: io.BufferedIOBase):
        self.stream, self.check = stream, codecs.getincrementaldecoder("utf-8")()
        start, line = b"", None
        while line is None:
            some = stream.read(1 << 16)
            start += some
            start = start.removeprefix(codecs.BOM_UTF8)
            end = next((m for m in re.finditer(rb"\r\n|\n|\r(?!$)", start) if start.count(b'"', 0, m.start()) % 2 == 0), None)
            if end:
                line, self.rest = start[: end.start()], start[end.end() :]
            elif not some:
                line, self.rest = start.rstrip(b"\r"), b""
        self.header: list[str] = next(csv.reader([line.decode("utf-8")]), [])
        self.check.decode(self.rest)

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        if self.rest:
            some, self.rest = self.rest, b""
            return some
        some = self.stream.read(size)
        self.check.decode(some, final=not some)
        return some


def tables(z: zipfile.ZipFile, member: zipfile.ZipInfo, wanted: list[str] | None) -> Iterator[tuple[list[str], np.ndarray, dict[str, pa.Array]]]:
    """(header, row numbers, text columns) of a member, batch by batch, in one parse; only wanted columns, or all."""
    with z.open(member) as raw:
        body = Body(raw)
        at = {name: i for i, name in enumerate(body.header)}  # the last of a repeated name
        names = [n for n in (at if wanted is None else wanted) if n in at]
        short: deque[tuple[int, str]] = deque()
        long: list[int] = []

        def odd(row: arrow_csv.InvalidRow) -> str:
            if row.actual_columns > row.expected_columns:
                long.append(row.number)
                return "error"
            short.append((row.number, row.text))
            return "skip"

        positions = [str(i) for i in range(len(body.header))]
        read = sorted({at[n] for n in names}) or [0]
        try:
            if not positions:
                return
            reader = arrow_csv.open_csv(
                pa.PythonFile(body, mode="r"),
                read_options=arrow_csv.ReadOptions(use_threads=False, block_size=BLOCK_BYTES, column_names=positions),
                parse_options=arrow_csv.ParseOptions(newlines_in_values=True, invalid_row_handler=odd),
                convert_options=arrow_csv.ConvertOptions(column_types=dict.fromkeys(positions, pa.string()), include_columns=[str(i) for i in read], strings_can_be_null=False, check_utf8=False),
            )
            number = 1

            def padded(until: int | None) -> list[tuple[int, list[str | None]]]:
                out = []
                while short and (until is None or short[0][0] < until):
                    row, text = short.popleft()
                    cells = next(csv.reader([text], strict=True), [])
                    out.append((row, [cells[i] if i < len(cells) else None for i in read]))
                return out

            def emitted(numbers: np.ndarray, columns: list[pa.Array], more: list[tuple[int, list[str | None]]]) -> tuple:
                if more:
                    order = pa.array(np.argsort(np.append(numbers, [m[0] for m in more]), kind="stable"))
                    columns = [pa.concat_arrays([c, pa.array([m[1][k] for m in more], pa.string())]).take(order) for k, c in enumerate(columns)]
                    numbers = np.sort(np.append(numbers, [m[0] for m in more]))
                return body.header, numbers, {n: columns[read.index(at[n])] for n in names}

            for batch in reader:
                # Rows of the batch take the numbers that no short row has; the reader may be a block ahead with those.
                taken, numbers = {row for row, _ in short}, []
                while len(numbers) < batch.num_rows:
                    some = np.arange(number, number + batch.num_rows - len(numbers))
                    number += len(some)
                    numbers.extend(i for i in some.tolist() if i not in taken) if taken else numbers.extend(some)
                yield emitted(np.array(numbers, np.int64), batch.columns, padded(number))
            if short:
                yield emitted(np.array([], np.int64), [pa.array([], pa.string()) for _ in read], padded(None))
        except pa.ArrowInvalid as e:
            if long:
                raise ValueError(f"row {long[0]} has more cells than the header") from e
            if "Empty CSV" not in str(e):
                raise
            if short:
                yield emitted(np.array([], np.int64), [pa.array([], pa.string()) for _ in read], padded(None))


def _cells(header: list[str], columns: dict[str, pa.Array], n: int) -> pa.MapArray:
    names = list(columns)
    values = pa.concat_arrays([columns[c] for c in names]) if names else pa.array([], pa.string())
    by_row = np.arange(n * len(names)).reshape(len(names), n).T.ravel()
    return pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * len(names), pa.int32()), pa.array(names * n, pa.string()), values.take(pa.array(by_row)))


#: Filters that the source decides itself, given a value and the filter's own; a null value passes only where it says so.
TESTS: dict[type, Callable] = {
    EqualTo: lambda v, f: v is not None and v == f.value,
    EqualNullSafe: lambda v, f: v == f.value,
    In: lambda v, f: v is not None and v in f.value,
    GreaterThan: lambda v, f: v is not None and v > f.value,
    GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
    LessThan: lambda v, f: v is not None and v < f.value,
    LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
    StringStartsWith: lambda v, f: v is not None and v.startswith(f.value),
    StringEndsWith: lambda v, f: v is not None and v.endswith(f.value),
    StringContains: lambda v, f: v is not None and f.value in v,
    IsNull: lambda v, f: v is None,
    IsNotNull: lambda v, f: v is not None,
}
NEGATED = {EqualTo, In, StringStartsWith, StringEndsWith, StringContains}


def passes(f: Filter, value: object) -> bool:
    """Whether a value passes a filter, as SQL has it: a comparison with null, or its negation, does not pass."""
    if isinstance(f, Not):
        return TESTS[IsNull](value, f) if isinstance(f.child, IsNotNull) else value is not None and not passes(f.child, value)
    return TESTS[type(f)](value, f)


def column_of(f: Filter) -> str | None:
    """The column of a filter that the source can decide, else none."""
    of = f.child if isinstance(f, Not) else f
    if type(of) not in TESTS or isinstance(f, Not) and type(of) not in NEGATED | {IsNotNull} or len(of.attribute) != 1:
        return None
    value = getattr(of, "value", 0)
    return None if value is None or isinstance(value, tuple | list) and None in value else of.attribute[0]


@dataclass
class Slice(InputPartition):
    path: str
    number: int


class Reading:
    """What a batch and a stream read alike."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.slices, self.schema = options["path"], int(options.get("slices_per_archive", 8)), schema
        self.filters: dict[str, list[Filter]] = {"trade_date": [], "raw_group": [], "source_file": []}
        if options.get("groups"):
            self.filters["raw_group"].append(In(("raw_group",), tuple(options["groups"].split(","))))
        if odd := [f.name for f in schema if f.name not in TECHNICAL and f.dataType != StringType()]:
            raise ValueError(f"cells are text: {', '.join(odd)}")

    def passes(self, column: str, value: object) -> bool:
        return all(passes(f, value) for f in self.filters[column])

    def slices_of(self, paths: list[str]) -> list[InputPartition]:
        return [Slice(p, i) for p in paths if self.passes("trade_date", archive_date(p)) for i in range(self.slices)]

    def wanted(self) -> list[str] | None:
        return None if "cells" in self.schema.names else [n for n in self.schema.names if n not in TECHNICAL]

    def batch(self, known: dict[str, object], n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        arrays = []
        for name in self.schema.names:
            kind = TECHNICAL.get(name, pa.string())
            arrays.append(columns[name] if name in columns else pa.array([known.get(name) if name in TECHNICAL else None] * n, kind))
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)

    def rows(self, z: zipfile.ZipFile, member: zipfile.ZipInfo, known: dict[str, object]) -> Iterator[pa.RecordBatch]:
        for header, numbers, columns in tables(z, member, self.wanted()):
            n = len(numbers)
            out = {k: v for k, v in columns.items() if k not in TECHNICAL} | {"row_num_in_file": pa.array(numbers)}
            if "cells" in self.schema.names:
                out["cells"] = _cells(header, columns, n)
            whole = self.batch(known | {"header": header}, n, out)
            for start in range(0, n, BATCH_ROWS):
                yield whole.slice(start, BATCH_ROWS)

    def whole(self, z: zipfile.ZipFile, member: zipfile.ZipInfo, known: dict[str, object]) -> Iterator[pa.RecordBatch]:
        """All batches of a member, or one row that says why it cannot be read."""
        held: list[pa.Buffer] | None = []
        size = 0
        try:
            for batch in self.rows(z, member, known):
                if held is not None:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(batch)
                    held.append(sink.getvalue())
                    size += held[-1].size
                    held = held if size <= HELD_BYTES else None
        except Exception as e:  # whatever ails a member is told in its row
            yield self.batch(known | {"error": f"{type(e).__name__}: {e}"}, 1, {})
            return
        if held is None:
            yield from self.rows(z, member, known)
        else:
            for buffer in held:
                yield from pa.ipc.open_stream(buffer)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        day = archive_date(partition.path)
        with opened(partition.path) as z:
            members = sorted((i for i in z.infolist() if i.filename.lower().endswith(".csv")), key=lambda i: i.filename)
            for member in members[partition.number :: self.slices]:
                name = original_name(member)
                group = group_of(name, day.year if day else None)
                if self.passes("source_file", name) and self.passes("raw_group", group):
                    yield from self.whole(z, member, {"trade_date": day, "source_file": name, "raw_group": group})


class ZipCsvReader(Reading, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.slices_of([p for p, _ in archives(self.path)])


class PushedReader(ZipCsvReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if (column := column_of(f)) in self.filters:
                self.filters[column].append(f)
            else:
                yield f


class ZipCsvStream(Reading, DataSourceStreamReader):
    """New archives since the last batch. An offset is the number of entries of the log of discoveries.

    An entry names the archives found at once, by path, size and time; it is written before its offset is told to Spark, so a
    repeated batch reads the archives it read before. An archive that was replaced is found anew.
    """

    def __init__(self, options: dict[str, str], schema: StructType):
        super().__init__(options, schema)
        self.system, self.log = located(options["log"])
        self.system.create_dir(self.log, recursive=True)

    def entries(self) -> list[int]:
        found = self.system.get_file_info(fs.FileSelector(self.log))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if re.fullmatch(r"\d+\.json", f.base_name))

    def entry(self, number: int) -> list[list]:
        with self.system.open_input_stream(f"{self.log}/{number}.json") as f:
            return json.loads(f.read())

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        done = self.entries()
        seen = {tuple(a) for n in done for a in self.entry(n)}
        new = [a for a in ((p, f.size, f.mtime_ns) for p, f in archives(self.path)) if a not in seen]
        last = done[-1] if done else 0
        if new:
            last += 1
            part = f"{self.log}/{last}.part"
            with self.system.open_output_stream(part) as f:
                f.write(json.dumps(new).encode())
            self.system.move(part, f"{self.log}/{last}.json")
        return {"entries": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.slices_of([a[0] for n in range(start["entries"] + 1, end["entries"] + 1) for a in self.entry(n)])

    def commit(self, end: dict) -> None:
        """The log stays: it says what was seen."""


class ZipCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ZipCsvReader:
        return (PushedReader if self.options.get("pushdown") == "true" else ZipCsvReader)(self.options, schema)

    def streamReader(self, schema: StructType) -> ZipCsvStream:
        return ZipCsvStream(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipCsv)


def scan(spark: SparkSession, path: str, schema: str = SCHEMA, days: list[date] | None = None, groups: list[str] | None = None) -> DataFrame:
    """Members of these days and groups (all, where none are named); nothing else is opened. The schema has trade_date and raw_group."""
    register(spark)
    rows = spark.read.format("zipcsv").schema(schema).option("pushdown", str(days is not None or groups is not None).lower()).load(path)
    if days is not None:
        rows = rows.where(F.col("trade_date").isin(days))
    return rows if groups is None else rows.where(F.col("raw_group").isin(groups))
