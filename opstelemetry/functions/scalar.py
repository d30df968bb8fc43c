"""Column helpers (F1–F11). All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_site(c: Column | str) -> Column:
    """keep letters and digits of a site name."""
    return F.regexp_replace(_col(c), "[^0-9a-zA-Z]+", "")


def epoch_col(c: Column | str) -> Column:
    """Epoch seconds as a 64-bit integer, NULL for text that is no number."""
    return _col(c).try_cast("bigint")


def to_ts(c: Column | str) -> Column:
    """epoch seconds to a timestamp."""
    return F.timestamp_seconds(epoch_col(c))


def _as_ts(c: Column | str) -> Column:
    return F.timestamp_seconds(_col(c).cast("bigint"))


def hour_of(c: Column | str) -> Column:
    """UTC hour of an epoch."""
    return F.hour(_as_ts(c))


def weekday_of(c: Column | str) -> Column:
    """UTC weekday of an epoch, Monday = 0."""
    return F.weekday(_as_ts(c))


def fmt_time(c: Column | str) -> Column:
    """an epoch as C-locale ``%c`` text, with the day padded by a space."""
    ts = _as_ts(c)
    day = F.lpad(F.dayofmonth(ts).cast("string"), 2, " ")
    return F.concat_ws(" ", F.date_format(ts, "EEE MMM"), day, F.date_format(ts, "HH:mm:ss yyyy"))


def hour_bucket(c: Column | str, seconds: int = 3600) -> Column:
    """number of the time bucket an epoch falls in."""
    return (_col(c) / F.lit(seconds)).cast("bigint")


def try_num(c: Column | str, to: str = "double") -> Column:
    """numeric cast that gives NULL for text that is no number."""
    return _col(c).try_cast(to)


def missing_as_null(c: Column | str) -> Column:
    """A double in which NaN counts as missing."""
    value = try_num(c)
    return F.when(~F.isnan(value), value)


def push_window(window: Column | str, newest: Column | str) -> Column:
    """drop the oldest step of a window array and append the newest."""
    window = _col(window)
    return F.concat(F.slice(window, F.lit(2), F.size(window) - 1), F.array(_col(newest)))
