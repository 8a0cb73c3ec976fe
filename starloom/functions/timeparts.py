"""Epochs, calendar parts, SAS days and date predicates.

Timestamps are `timestamp_ntz` in UTC, and epochs are converted by adding to the zero point,
so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Milliseconds kept."""
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def epoch_ms_to_seconds(ms: Column) -> Column:
    """Cut to whole seconds."""
    return F.timestamp_add("SECOND", F.floor(ms / F.lit(1000)), _epoch())


def start_time(ms: Column, precision: str = "s") -> Column:
    if precision not in ("ms", "s"):
        raise ValueError(f"precision must be 'ms' or 's', not {precision!r}")
    return epoch_ms_to_timestamp(ms) if precision == "ms" else epoch_ms_to_seconds(ms)


def timestamp_to_epoch_ms(ts: Column) -> Column:
    return F.floor(F.timestamp_diff("MICROSECOND", _epoch(), ts) / F.lit(1000)).cast("bigint")


def epoch_ms_to_text(ms: Column, fmt: str = SECOND_FORMAT) -> Column:
    return F.date_format(epoch_ms_to_seconds(ms), fmt)


def timestamp_to_text(ts: Column, fmt: str = SECOND_FORMAT) -> Column:
    return F.date_format(ts, fmt)


def weekday_mon0(ts: Column) -> Column:
    return F.weekday(ts)


def weekday_sun0(ts: Column, as_text: bool = False) -> Column:
    day = F.dayofweek(ts) - F.lit(1)
    return day.cast("string") if as_text else day


def calendar_parts(ts: Column, weekday: str = "sun0") -> list[Column]:
    """hour, day, ISO week, month, year and weekday, named as in the time dimension."""
    weekdays = {
        "sun0": weekday_sun0(ts),
        "mon0": weekday_mon0(ts),
        "sun0_text": weekday_sun0(ts, as_text=True),
    }
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekdays[weekday].alias("weekday"),
    ]


def sas_date(days: Column) -> Column:
    """Days since 1960-01-01 (often held as a double) as a date."""
    return F.date_add(F.lit("1960-01-01").cast("date"), days.cast("int"))


def sas_date_text(days: Column) -> Column:
    return F.date_format(sas_date(days), "yyyy-MM-dd")


def parse_date(text: Column) -> Column:
    return text.try_cast("date")


def parse_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def within_years(day: Column, min_year: int | None = None, max_year: int | None = None) -> Column:
    """Inclusive year bounds as a range on the raw column, so that the scan can use them."""
    keep = F.lit(True)
    if min_year is not None:
        keep = keep & (day >= F.make_date(F.lit(min_year), F.lit(1), F.lit(1)))
    if max_year is not None:
        keep = keep & (day < F.make_date(F.lit(max_year + 1), F.lit(1), F.lit(1)))
    return keep


def on_day(ts: Column, year: int, month: int, day: int) -> Column:
    """One calendar day as a half-open range on the raw column."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(day))
    return (ts >= first.cast("timestamp_ntz")) & (ts < F.date_add(first, 1).cast("timestamp_ntz"))


def shift(ts: Column, unit: str, amount: int | Column) -> Column:
    """Timestamp plus or minus an interval."""
    return F.timestamp_add(unit, F.lit(amount) if isinstance(amount, int) else amount, ts)
