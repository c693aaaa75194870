"""The incremental window: which column tells that a row changed, and which rows are due."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Change columns by priority, the first one present wins.
EFFECTIVE = (
    "updated_at_epoch",
    "updated_epoch",
    "modified_at_epoch",
    "created_at_epoch",
    "updated_at",
    "modified_at",
    "created_at",
    "update_time",
    "created_date",
)
EXTENDED = (
    "updated_at_epoch",
    "updated_epoch",
    "modified_at_epoch",
    "last_updated_epoch",
    "created_at_epoch",
    "updated_at",
    "updated_date",
    "modified_at",
    "modified_date",
    "last_updated",
    "update_time",
    "created_at",
    "created_date",
)

TEXT_FORMAT = "%Y-%m-%d %H:%M:%S"
DATE_FORMAT = "%Y-%m-%d"


def resolve_change_column(source: DataFrame | Iterable[str], order: Sequence[str] = EFFECTIVE) -> str | None:
    """The column that tells when a row last changed; None means the table is scanned whole."""
    names = set(source.columns if isinstance(source, DataFrame) else source)
    return next((name for name in order if name in names), None)


def utc(moment: datetime) -> datetime:
    """A time without zone is in UTC, whatever the zone of the machine."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _moment(text: str | datetime) -> datetime:
    if isinstance(text, datetime):
        return text
    return datetime.strptime(text, TEXT_FORMAT if " " in text else DATE_FORMAT)


@dataclass(frozen=True)
class IncrementalWindow:
    """Inclusive bounds in UTC; a missing bound is open, both missing means no filter."""

    start: datetime | None = None
    end: datetime | None = None

    @property
    def active(self) -> bool:
        return self.start is not None or self.end is not None

    @classmethod
    def resolve(
        cls,
        base: str | datetime | None,
        direction: str | None,
        days: int | str | None = 0,
        hours: int | str | None = 0,
        *,
        lenient: bool = False,
    ) -> IncrementalWindow:
        """``old`` ends at the base, ``new`` starts there; counts close the other side.

        What cannot be read gives no filter. ``lenient`` also accepts a direction in
        any letter case and values followed by a ``#`` remark.
        """

        def read(value: int | str | datetime | None) -> str | datetime:
            if isinstance(value, datetime):
                return value
            text = "" if value is None else str(value).strip()
            return text.split("#")[0].strip() if lenient else text

        way = str(read(direction))
        way = way.lower() if lenient else way
        try:
            if not read(base):
                return cls()
            at = _moment(read(base))
            span = timedelta(days=int(read(days) or 0), hours=int(read(hours) or 0))
        except ValueError:
            return cls()
        if way == "old":
            return cls(at - span if span else None, at)
        if way == "new":
            return cls(at, at + span if span else None)
        return cls()

    @classmethod
    def cutoff(cls, now: datetime, days: int = 0, hours: int = 0) -> IncrementalWindow:
        """Counts without a base date: everything up to today's midnight plus the counts."""
        midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
        return cls(None, midnight + timedelta(days=days, hours=hours))

    @classmethod
    def between(
        cls, start: str | None = None, end: str | None = None, *, end_of_day: bool = False
    ) -> IncrementalWindow:
        """Bounds given as text; with ``end_of_day`` a date-only end covers that day."""
        first = _moment(start) if start else None
        last = _moment(end) if end else None
        if last is not None and end_of_day and " " not in end:
            last = last.replace(hour=23, minute=59, second=59)
        return cls(first, last)


def _bound(moment: datetime, column: str, dtype: T.DataType) -> Column:
    """The bound as a literal of the column's own type, so that the filter reaches the scan."""
    if isinstance(dtype, T.NumericType) or "epoch" in column.lower():
        # Numbers are epoch milliseconds, as they are for marks.
        return F.lit(int(utc(moment).timestamp() * 1000))
    plain = utc(moment).astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(plain.isoformat(sep=" ")).cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampType):
        return F.lit(utc(moment)).cast(T.TimestampType())
    return F.lit(plain.strftime(TEXT_FORMAT))


def window_condition(df: DataFrame, window: IncrementalWindow, column: str) -> Column:
    """Both bounds are inclusive and a NULL change value never matches."""
    dtype = df.schema[column].dataType
    condition = F.lit(True)
    if window.start is not None:
        condition = condition & (F.col(column) >= _bound(window.start, column, dtype))
    if window.end is not None:
        condition = condition & (F.col(column) <= _bound(window.end, column, dtype))
    return condition


def apply_window(
    df: DataFrame,
    window: IncrementalWindow | None,
    column: str | None = None,
    order: Sequence[str] = EFFECTIVE,
) -> DataFrame:
    """The rows that changed within the window; a table without a change column stays whole."""
    column = column or resolve_change_column(df, order)
    if window is None or not window.active or column is None:
        return df
    return df.filter(window_condition(df, window, column))
