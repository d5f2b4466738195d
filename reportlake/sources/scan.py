"""Landed reports as a Spark data source: one table over any number of files, whatever their headers.

Reports land as ``extract=E/app_id=A/report_type=T/from_date=D/to_date=D/<file>`` below a root (names escaped as
Spark escapes partition values). Filters on these five columns are pushed into the listing, which walks only folders
that pass; the files left are packed into partitions by size. Each is read where its task runs, by its own
header: the first record with anything in it, which may hold quoted line breaks. Cells come out as text under the destination's names, typed
afterwards by built-in expressions (``operators.parse.parse_scan``).

A byte order mark goes, bytes that are no UTF-8 become replacement characters, blank lines are no records, short
records are filled with blanks, cells beyond the header are dropped. A file without a header, or without a date column, gives
one row that holds only the ``problem``.

Files are opened by Arrow's file systems (local and shared folders, S3, GCS, HDFS).
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import operator
import re
from collections.abc import Callable, Iterator
from datetime import date, datetime, timezone
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

from reportlake.cluster import ship
from reportlake.sources.headers import CELLS, SALES, Header, read_header

#: Folder levels of a landed report, in their order.
LEVELS = ("extract", "app_id", "report_type", "from_date", "to_date")
DATES = LEVELS[3:]
FILE = "path string, extract string, app_id string, report_type string, from_date date, to_date date"
LISTING = f"{FILE}, bytes bigint, modified timestamp"
LEGS = ("event_unique_users", "event_counter", SALES, "extra")
RECORDS = "path string, nth bigint, cells array<string>"
PAIRS = "array<struct<name:string,cell:string>>"
ROWS = f"{FILE}, problem string, notes string, sales_currency string, nth bigint, {', '.join(f'{c} string' for c in CELLS)}, {', '.join(f'{c} {PAIRS}' for c in LEGS)}"
#: Bytes of files that one task reads, unless a single file is larger.
PARTITION_BYTES = 32 << 20
#: Bytes that a file is read by, of which Arrow holds up to 32 blocks ahead, and by which one with longer records is: the longest record.
BLOCK, LONGEST = 1 << 20, 8 << 20
#: Most rows of a batch handed to Spark, all of whose columns are made at once.
BATCH = 16_384
EMPTY, NO_DATE = "empty report", "report has no Date column"

Test = Callable[[object], bool]


class File(NamedTuple):
    path: str
    extract: str | None = None
    app_id: str | None = None
    report_type: str | None = None
    from_date: date | None = None
    to_date: date | None = None
    bytes: int = 0
    modified: datetime | None = None


class Files(ds.InputPartition):
    def __init__(self, files: list[File]) -> None:
        self.files = files


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it, which is taken as it stands (Spark's paths are not percent-encoded)."""
    if m := re.fullmatch(r"(?:file:)?/+(.*)", path, re.DOTALL):
        return fs.LocalFileSystem(), "/" + m[1]
    if m := re.fullmatch(r"([a-z0-9+]+://[^/]*)/*(.*)", path, re.DOTALL):
        files, top = fs.FileSystem.from_uri(m[1] + "/")
        return files, f"{top.rstrip('/')}/{m[2]}"
    raise ValueError(f"neither an absolute path nor a URI: {path!r}")


# Listing


def level_value(level: str, name: str) -> object:
    """The value that a folder ``level=value`` stands for; None if it is not one."""
    key, _, text = name.partition("=")
    if key != level or not text:
        return None
    text = unquote(text)
    if level not in DATES:
        return text
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def walked(root: str, tests: dict[str, list[Test]]) -> Iterator[File]:
    """The files below a root whose folders pass all tests, in the order of their paths."""
    files, top = store(root.rstrip("/"))
    prefix = root.rstrip("/")[: len(root.rstrip("/")) - len(top)] if root.rstrip("/").endswith(top) else ""

    def walk(folder: str, values: tuple) -> Iterator[File]:
        depth = len(values)
        found = sorted(files.get_file_info(fs.FileSelector(folder, allow_not_found=depth == 0)), key=lambda i: i.path)
        for info in found:
            if depth == len(LEVELS):
                if info.type == fs.FileType.File and info.base_name[0] not in "._":
                    yield File(prefix + info.path, *values, info.size, info.mtime and info.mtime.astimezone(timezone.utc))
            elif info.type == fs.FileType.Directory:
                value = level_value(LEVELS[depth], info.base_name)
                if value is not None and all(t(value) for t in tests.get(LEVELS[depth], ())):
                    yield from walk(info.path, (*values, value))

    yield from walk(top, ())


def packed(files: list[File], most: int) -> list[Files]:
    """Files in their order, in partitions of at most ``most`` bytes; a larger one has its own."""
    out, room = [], 0
    for f in files:
        cost = max(f.bytes, most // 64)  # opening counts too
        if not out or cost > room:
            out.append(Files([]))
            room = most
        out[-1].files.append(f)
        room -= cost
    return out


# Reading


def _text(path: str) -> pa.NativeFile:
    """A file as clean UTF-8 from its first character on that is no white space."""
    files, inner = store(path)
    decoder, begun = codecs.getincrementaldecoder("utf-8-sig")("replace"), False

    def clean(data: bytes) -> bytes:
        nonlocal begun
        text = decoder.decode(bytes(data), not data)
        if not begun:
            text = text.lstrip()
            begun = bool(text)
        return text.encode()

    return pa.TransformInputStream(files.open_input_stream(inner), clean)


def first_record(path: str) -> list[str]:
    """The cells of the header; none if the file holds nothing. No more than its first blocks are read."""
    with _text(path) as data:
        for record in csv.reader(io.TextIOWrapper(data, "utf-8", "replace", newline="")):
            if any(c.strip() for c in record):
                return record
    return []


def records(path: str, width: int) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """Batches of the records behind the header: their numbers in the file (the header's is 1), and a column a cell.

    What a task holds is bounded whatever the file's size: few small blocks, and batches of at most ``BATCH`` rows. At a
    record that no small block holds, the file is read anew by large ones, and what has been given out is passed over.
    """
    done = [1, 0]  # numbers of the last whole and the last ragged record given out
    for block in (BLOCK, LONGEST):
        try:
            for numbers, columns in _records(path, width, block, done):
                for i in range(0, len(numbers), BATCH):
                    yield numbers[i : i + BATCH], [c.slice(i, BATCH) for c in columns]
            return
        except pa.ArrowInvalid as e:
            if block == LONGEST or "straddl" not in str(e):
                raise


def _records(path: str, width: int, block: int, done: list[int]) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """``records`` by blocks of one size, behind those that are ``done``, which it keeps up to date."""
    odd: list[tuple[int, list[str]]] = []
    given: set[int] = set()
    blank: list[int] = []

    def ragged(row: pa.csv.InvalidRow) -> str:
        # Arrow leaves such a record out; it is read here and put in place.
        cells = next(csv.reader(io.StringIO(row.text, newline="")), [])
        given.add(row.number)
        if any(c.strip() for c in cells):
            odd.append((row.number, [*cells, *[""] * width][:width]))
        else:
            blank.append(row.number)
        return "skip"

    def shifted(numbers: np.ndarray) -> np.ndarray:
        return numbers - np.searchsorted(blank, numbers) if blank else numbers

    def taken() -> list[tuple[int, list[str]]]:
        more = [o for o in odd if o[0] > done[1]]
        done[1] = max([done[1], *[n for n, _ in odd[-1:]]])
        odd.clear()
        return more

    names = [f"c{i}" for i in range(width)]
    options = {
        "read_options": pa.csv.ReadOptions(use_threads=False, block_size=block, column_names=names),
        "parse_options": pa.csv.ParseOptions(newlines_in_values=True, invalid_row_handler=ragged),
        "convert_options": pa.csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False),
    }
    at = 0  # the last number used
    with _text(path) as data:
        for batch in pa.csv.open_csv(data, **options):
            n = batch.num_rows
            numbers = np.arange(at + 1, at + 1 + n + len(given))
            if given:  # numbers of ragged records are theirs
                numbers = numbers[~np.isin(numbers, list(given))][:n]
            if n:
                at = int(numbers[-1])
                given = {g for g in given if g > at}
            columns = [batch.column(i) for i in range(width)]
            keep = numbers > done[0]
            if not keep.all():
                numbers, columns = numbers[keep], [c.filter(pa.array(keep)) for c in columns]
            done[0] = max(done[0], at)
            if more := taken():
                numbers = np.concatenate([numbers, [n for n, _ in more]])
                columns = [pa.concat_arrays([c, pa.array([r[i] for _, r in more], pa.string())]) for i, c in enumerate(columns)]
            if len(numbers):
                yield shifted(numbers), columns
    if more := taken():
        yield shifted(np.array([n for n, _ in more])), [pa.array([r[i] for _, r in more], pa.string()) for i in range(width)]


def _pairs(names: list[str], columns: list[pa.Array], n: int) -> pa.Array:
    """For every row the list of (name, cell) over some columns."""
    k = len(columns)
    if not k:
        return pa.array([[]] * n, pa.list_(pa.struct({"name": pa.string(), "cell": pa.string()})))
    cells = pa.concat_arrays(columns).take(pa.array(np.arange(n * k).reshape(k, n).T.ravel()))
    held = pa.StructArray.from_arrays([pa.array(names, pa.string()).take(pa.array(np.tile(np.arange(k), n))), cells], ["name", "cell"])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), held)


def described(names: list[str]) -> tuple[str | None, str | None, str | None, list[Header]]:
    """What a header says: (problem, notes, the one currency of its sales, its columns)."""
    if not names:
        return EMPTY, None, None, []
    read = [read_header(h) for h in names]
    columns = [h.column for h in read if h.kind == "column"]
    money = sorted({h.currency for h in read if h.currency})
    notes = [f"unknown headers: {', '.join(n for n, h in zip(names, read) if h.kind == 'unknown')}"] if any(h.kind == "unknown" for h in read) else []
    notes += ["several sales currencies: " + ", ".join(money)] if len(money) > 1 else []
    notes += [f"several columns for {c}" for c in dict.fromkeys(columns) if columns.count(c) > 1]
    return None if "date" in columns else NO_DATE, "; ".join(notes) or None, money[0] if len(money) == 1 else None, read


def report(file: File) -> Iterator[pa.RecordBatch]:
    """The rows of one file, with the file's own columns."""
    names = first_record(file.path)
    problem, notes, money, read = described(names)
    same = lambda v, n, kind=pa.string(): pa.repeat(pa.scalar(v, kind), n)

    def batch(numbers: np.ndarray, columns: list[pa.Array]) -> pa.RecordBatch:
        n = len(numbers)
        out = {c: same(getattr(file, c), n, pa.date32() if c in DATES else pa.string()) for c in ("path", *LEVELS)}
        out |= {"problem": same(problem, n), "notes": same(notes, n), "sales_currency": same(money, n), "nth": pa.array(numbers, pa.int64())}
        by = {h.column: c for h, c in zip(read, columns) if h.kind == "column"}  # of repeated headers the last holds
        if "campaign" not in by and "campaign_name" in by:  # decided by the header, not by each row
            by["campaign"] = by["campaign_name"]
        out |= {c: by.get(c, same(None, n)) for c in CELLS}
        for leg in LEGS:
            mine = [(name if leg == "extra" else h.event, c) for name, h, c in zip(names, read, columns) if (h.kind == "unknown" if leg == "extra" else h.kind == "event" and h.column == leg)]
            out[leg] = _pairs([m[0] for m in mine], [m[1] for m in mine], n)
        return pa.RecordBatch.from_pydict(out)

    if problem:
        yield batch(np.zeros(1, np.int64), [])
        return
    for numbers, columns in records(file.path, len(names)):
        yield batch(numbers, columns)


def plain(file: File) -> Iterator[pa.RecordBatch]:
    """The records of one file behind its header, as arrays of cells."""
    width = len(first_record(file.path))
    for numbers, columns in records(file.path, width) if width else ():
        n = len(numbers)
        cells = pa.concat_arrays(columns).take(pa.array(np.arange(n * width).reshape(width, n).T.ravel()))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), cells)
        yield pa.RecordBatch.from_arrays([pa.repeat(file.path, n), pa.array(numbers, pa.int64()), lists], ["path", "nth", "cells"])


# The source

COMPARE = {ds.EqualTo: operator.eq, ds.EqualNullSafe: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge, ds.LessThan: operator.lt, ds.LessThanOrEqual: operator.le, ds.StringStartsWith: str.startswith}


def test_of(f: ds.Filter) -> tuple[str, Test] | None:
    """(column, test) of a filter that the listing decides by itself; None for any other. Listed values are never null."""
    if isinstance(f, ds.Not):
        inner = test_of(f.child)
        return inner and (inner[0], lambda v: not inner[1](v))
    if getattr(f, "attribute", ("",))[0] not in LEVELS:
        return None
    if isinstance(f, ds.IsNotNull):
        return f.attribute[0], lambda _: True
    if isinstance(f, ds.In):
        return f.attribute[0], lambda v: v in f.value
    compare = COMPARE.get(type(f))
    if compare is None or f.value is None:
        return None
    return f.attribute[0], lambda v: compare(v, f.value)


class LandedReports(ds.DataSource):
    """Options: ``path``, the root; or ``files``, a JSON list of paths whose folders say nothing; ``what``: reports,
    files (the listing alone) or cells (records by place); ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "landed_reports"

    def schema(self) -> str:
        return {"files": LISTING, "cells": RECORDS}.get(self.options.get("what"), ROWS)

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


class Reader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]):  # noqa: N802
        for f in filters:
            if test_of(f) and "path" in self.options:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        tests: dict[str, list[Test]] = {}
        for f in self.filters:
            column, test = test_of(f)
            tests.setdefault(column, []).append(test)
        most = int(self.options.get("partition_bytes", PARTITION_BYTES))
        if "path" in self.options:
            return packed(list(walked(self.options["path"], tests)), most) or [Files([])]
        sized = []
        for path in json.loads(self.options["files"]):
            files, inner = store(path)
            sized.append(File(path, bytes=max(0, files.get_file_info(inner).size or 0)))
        return packed(sized, most) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        if self.options.get("what") == "files":
            kinds = [pa.string()] * 4 + [pa.date32()] * 2 + [pa.int64(), pa.timestamp("us", "UTC")]
            columns = zip(*partition.files) if partition.files else [[]] * len(File._fields)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], list(File._fields))
            return
        for file in partition.files:
            yield from plain(file) if self.options.get("what") == "cells" else report(file)


def _reader(spark: SparkSession):
    ship(spark)
    spark.dataSource.register(LandedReports)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("landed_reports")


def landed_reports(spark: SparkSession, root: str) -> DataFrame:
    """All reports below a root; filters on extract, app_id, report_type, from_date and to_date prune the files."""
    return _reader(spark).option("path", root).load()


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """The listing of a root: a row a file, nothing of it read."""
    return _reader(spark).option("path", root).option("what", "files").load()


def reports_at(spark: SparkSession, paths: list[str], what: str = "reports") -> DataFrame:
    """The reports at the given paths, wherever they lie."""
    return _reader(spark).option("files", json.dumps(paths)).option("what", what).load()
