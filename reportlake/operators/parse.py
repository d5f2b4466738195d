"""Reports of any known shape to destination rows: one select, then one filter."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.functions.coerce import to_count, to_day, to_number, to_text
from reportlake.functions.maps import event_map, paired_map
from reportlake.schema import COLUMN_NAMES, COUNTS, DIMENSIONS, MAPS, METRICS
from reportlake.sources.headers import CELLS, SALES, Header, read_header, report_currency, report_format


@dataclass(frozen=True)
class Context:
    """What a report was asked for; stamped onto its rows."""

    app_id: str
    report_type: str
    category: str
    is_retargeting: bool
    extract: str
    run_id: str
    loaded_at: datetime
    currency: str | None = None


@dataclass(frozen=True)
class Parsed:
    """Destination rows still to be filtered by day and source, and what the headers told."""

    all_rows: DataFrame
    format: str
    currency: str
    unknown: list[str]
    warnings: list[str]
    days: tuple[date, date] | None
    excluded: tuple[str, ...]

    def _tests(self) -> tuple[Column, Column]:
        inside = F.lit(True) if self.days is None else F.col("date").between(*map(F.lit, self.days))
        return inside, F.col("media_source").isin(*self.excluded) if self.excluded else F.lit(False)

    @property
    def rows(self) -> DataFrame:
        inside, excluded = self._tests()
        return self.all_rows.where(inside & ~excluded)

    def counts(self) -> tuple[int, int, int]:
        """(kept, out of range, excluded): the range is tested first, so the last two are disjoint. Fails on bad dates."""
        inside, excluded = self._tests()
        bad = F.count_if(F.col("date").isNull())
        r = self.all_rows.agg(bad, F.count_if(inside & ~excluded), F.count_if(~inside), F.count_if(inside & excluded)).first()
        if r[0]:
            raise ValueError(f"{r[0]} rows without a readable date")
        return r[1], r[2], r[3]


def parse_report(headers: Sequence[str], raw: DataFrame, context: Context, days: tuple[date, date] | None = None, exclude: Iterable[str] = (), keep_unknown: bool = False, carry: Sequence[str] = ()) -> Parsed:
    """Reads ``raw``, whose columns belong to ``headers`` in order.

    Of repeated headers the last holds. A report without a date column is an error. Rows are neither merged nor
    deduplicated. The context's texts may be columns of ``raw`` behind the cells, and ``carry`` names more of them.
    """
    read = [read_header(h) for h in headers]
    cells = [F.col(c) for c in raw.columns]
    by_column: dict[str, Column] = {h.column: c for h, c in zip(read, cells) if h.kind == "column"}
    if "date" not in by_column:
        raise ValueError("report has no Date column")
    unknown = [h for h, r in zip(headers, read) if r.kind == "unknown"]
    currency, notes = report_currency(read, context.currency)
    notes += [f"several columns for {c}" for c in by_column if sum(r.column == c and r.kind == "column" for r in read) > 1]
    if unknown:
        notes.insert(0, "unknown headers: " + ", ".join(unknown))
    legs = {name: event_map(_legs(name, read, cells), kind) for name, kind in MAPS.items()}
    if keep_unknown:
        legs["extra"] = event_map([(h, to_text(c)) for h, r, c in zip(headers, read, cells) if r.kind == "unknown"], "string")
    if "campaign" not in by_column and "campaign_name" in by_column:  # decided by the headers, not by each row
        by_column["campaign"] = by_column["campaign_name"]
    rows = raw.select(*_destination(by_column, legs, context, F.lit(currency)), *carry)
    return Parsed(rows, report_format(headers), currency, unknown, notes, days, tuple(exclude))


def _destination(cells: dict[str, Column], legs: dict[str, Column], context: Context, currency: Column) -> list[Column]:
    """The destination's columns from text cells by column; columns without a cell are blank or null."""
    out: dict[str, Column] = {
        "app_id": F.lit(context.app_id),
        "date": to_day(cells["date"]),
        "report_type": F.lit(context.report_type),
        "category": F.lit(context.category),
        "is_retargeting": F.lit(context.is_retargeting).cast("int"),
        "currency": currency,
        "_extract": F.lit(context.extract),
        "_run_id": F.lit(context.run_id),
        "_loaded_at": F.lit(context.loaded_at).cast("timestamp_ntz"),
    }
    for name in DIMENSIONS:
        out[name] = to_text(cells[name]) if name in cells else F.lit("")
    for name in METRICS:
        cell = cells.get(name)
        kind = "bigint" if name in COUNTS else "double"
        out[name] = F.lit(None).cast(kind) if cell is None else to_count(cell) if name in COUNTS else to_number(cell)
    return [(out | legs)[c].alias(c) for c in COLUMN_NAMES]


def parse_scan(scanned: DataFrame, context: Context, currency: Column, keep_unknown: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Destination rows of scanned reports (``sources.scan``), whose header each file has of its own.

    ``currency`` is the hint where a report's sales headers name none or several. The context's texts may be columns.
    """
    legs = {}
    for name, kind in MAPS.items():
        read = to_text if name == "extra" else to_number if name == SALES else to_count
        legs[name] = paired_map(F.col(name), read, kind) if name != "extra" or keep_unknown else event_map([], kind)
    known = F.coalesce("sales_currency", currency, F.lit(""))
    return scanned.select(*_destination({c: F.col(c) for c in CELLS}, legs, context, known), *carry)


def _legs(column: str, read: Sequence[Header], cells: Sequence[Column]) -> list[tuple[str, Column]]:
    value = to_number if column == SALES else to_count
    return [(h.event, value(c)) for h, c in zip(read, cells) if h.kind == "event" and h.column == column]
