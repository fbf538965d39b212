"""Date/time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellflux import factors


def split_date_time(col: Column) -> tuple[Column, Column]:
    """``"YYYY-MM-DDTHH:MM"`` -> (date text, time text)."""
    parts = F.split(col, "T")
    return parts.getItem(0), parts.getItem(1)


def parse_day(text: Column) -> Column:
    """day text -> DATE (a join on a DATE is cheaper than on text)."""
    return F.to_date(text)


def day_text(col: Column) -> Column:
    """DATE/TIMESTAMP -> ``yyyy-MM-dd``."""
    return F.date_format(col, "yyyy-MM-dd")


def minute_text(ts: Column) -> Column:
    """timestamp -> ``yyyy-MM-dd'T'HH:mm``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm")


def sensor_line(ts: Column, payload: Column) -> Column:
    """``"<minute>,<payload>"``."""
    return F.concat_ws(",", minute_text(ts), payload)


def file_stamp(ts: Column) -> Column:
    """``YYYYMMDD_HHMM``."""
    return F.date_format(ts, "yyyyMMdd_HHmm")


def floor_to_hours(ts: Column, hours: int) -> Column:
    """F16: floor a timestamp to a multiple of ``hours`` since the epoch."""
    step = hours * 3600
    secs = F.unix_timestamp(ts)
    return F.timestamp_seconds(secs - secs % F.lit(step))


def six_hour_window_end(ts: Column, hours: int = 6) -> Column:
    """the end of a forecast window that starts at ``ts``."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def duration_parts(seconds: Column) -> Column:
    """seconds -> struct(days, hours, minutes)."""
    s = seconds.cast("long")
    return F.struct(
        F.floor(s / F.lit(86400)).cast("int").alias("days"),
        F.floor((s % F.lit(86400)) / F.lit(3600)).cast("int").alias("hours"),
        F.floor((s % F.lit(3600)) / F.lit(60)).cast("int").alias("minutes"),
    )


def epoch_days_to_date(days: Column) -> Column:
    """days since 1970-01-01 -> DATE."""
    return F.date_add(F.lit(factors.FIELD_EPOCH).cast("date"), days.cast("int"))


def month_start_days(year: int, month: Column) -> Column:
    """F21 inverse: first day of ``month`` in ``year`` as days since the epoch."""
    return F.datediff(F.make_date(F.lit(year), month, F.lit(1)), F.lit(factors.FIELD_EPOCH).cast("date"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP."""
    return F.to_timestamp(text)


def padded(col: Column, width: int = 2) -> Column:
    """zero padded integer text."""
    return F.lpad(col.cast("string"), width, "0")
