"""Event-time parsing, window filters and hour buckets."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted timestamp text and the hour format of window bounds.
EVENT_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})? UTC$"
HOUR_FORMAT = "%Y-%m-%d %H"


def as_hour(value: str | datetime) -> datetime:
    """A window bound given as ``'2022-04-01 13'`` or as a datetime."""
    if isinstance(value, datetime):
        return value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value
    try:
        return datetime.strptime(value, HOUR_FORMAT)
    except ValueError:
        raise ValueError(f"expected 'YYYY-MM-DD HH', got {value!r}") from None


def check_range(start: str | datetime, end: str | datetime) -> tuple[datetime, datetime]:
    start, end = as_hour(start), as_hour(end)
    if end <= start:
        raise ValueError(f"window end {end} is not after its start {start}")
    return start, end


def parse_event_time(text: str | Column) -> Column:
    """Timestamp of ``YYYY-MM-DD HH:MM:SS[.ffffff] UTC`` text, NULL for anything else.

    The pattern guard is needed because the timestamp parser also takes a bare
    year, a date or a zone offset.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(EVENT_TIME_PATTERN), F.try_to_timestamp(text))


def _bound(value: datetime, dtype: T.DataType) -> Column:
    """Literal of the column's own type, so the comparison reaches the Parquet scan."""
    zone = "" if isinstance(dtype, T.TimestampNTZType) else "Z"
    return F.lit(value.isoformat(sep=" ") + zone).cast(dtype)


def time_window(
    df: DataFrame,
    start: str | datetime | None,
    end: str | datetime | None,
    *,
    ts: str = "ts",
    closed: str = "left",
    date_col: str = "event_date",
) -> DataFrame:
    """Rows whose ``ts`` is in ``[start, end)``, or ``[start, end]`` with ``closed="both"``.

    Either bound may be None. Where the table has the partition column
    ``date_col`` the matching date bounds are added, since Spark cannot derive
    them from a bound on ``ts``.
    """
    if closed not in ("left", "both"):
        raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")
    if start is not None and end is not None:
        start, end = check_range(start, end)
    dtype = df.schema[ts].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{ts} is {dtype.simpleString()}; parse it with parse_event_time first")
    has_date = date_col in df.columns
    if start is not None:
        low = as_hour(start)
        df = df.filter(F.col(ts) >= _bound(low, dtype))
        if has_date:
            df = df.filter(F.col(date_col) >= F.lit(low.date()))
    if end is not None:
        high = as_hour(end)
        bound = _bound(high, dtype)
        df = df.filter(F.col(ts) <= bound if closed == "both" else F.col(ts) < bound)
        if has_date:
            df = df.filter(F.col(date_col) <= F.lit(high.date()))
    return df


def hour_bucket(ts: str = "ts") -> Column:
    """Start of the UTC hour of ``ts``, in its own type and whatever the session time zone."""
    return F.window(ts, "1 hour")["start"]


def gap_seconds(earlier: Column, later: Column) -> Column:
    """Seconds from ``earlier`` to ``later``, to the microsecond.

    Taken from the interval, since ``timestamp_diff`` reads a wall time in the
    session time zone, where a day may have 23 hours.
    """
    gap = later - earlier
    parts = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60}
    whole = sum((F.extract(F.lit(unit), gap) * size for unit, size in parts.items()), F.lit(0))
    return whole + F.extract(F.lit("SECOND"), gap).cast("double")
