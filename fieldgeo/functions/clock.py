"""Clocks and calendars. Timestamps are UTC; the session's time zone should be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GPS_EPOCH = 315964800  # 1980-01-06 00:00:00 UTC
WEEK = 604800


def gps_to_utc(week: Column, second: Column, leap: int = 16) -> Column:
    return F.timestamp_micros(F.round((F.lit(GPS_EPOCH - leap) + week * WEEK + second) * 1e6).cast("long"))


def ms_to_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy/MM/dd")


def ms_to_time(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "HH:mm:ss.SSSSSS")


def run_id(prefix: Column | str, start: Column, end: Column) -> Column:
    stamp = lambda t: F.date_format(t, "yyyyMMdd_HHmmss")
    return F.concat_ws("_", F.lit(prefix) if isinstance(prefix, str) else prefix, stamp(start), stamp(end))


def to_local(ts: Column, zone: Column) -> Column:
    return F.from_utc_timestamp(ts, zone)


def capture_ms(local: Column, zone: Column, frame: Column, rate: Column) -> Column:
    """Epoch ms of a frame from a local capture time at frame 0 and a frame rate per second."""
    return F.unix_millis(F.to_utc_timestamp(local, zone)) + F.round(frame / rate * 1000).cast("long")


def _clock_parts(text: Column) -> tuple[Column, Column, Column, Column]:
    return (F.substring(text, 1, 2).try_cast("int"), F.substring(text, 3, 2).try_cast("int"), F.substring(text, 5, 2).try_cast("int"), F.substring(text, 7, 10))


def roll_clock(text: Column) -> Column:
    """`HHmmss[.f]` with seconds or minutes past 59 carried over; hours wrap, the date doesn't change."""
    h, m, s, rest = _clock_parts(text)
    total = h * 3600 + m * 60 + F.when(s > 59, 60).otherwise(s)
    total = F.when(m > 59, (h + 1) * 3600 + F.when(s > 59, 0).otherwise(s)).otherwise(total)
    return F.concat(hhmmss(F.pmod(total, F.lit(86400))), rest)


def true_clock(text: Column) -> Column:
    """As roll_clock by plain arithmetic on all units."""
    h, m, s, rest = _clock_parts(text)
    return F.concat(hhmmss(F.pmod(h * 3600 + m * 60 + s, F.lit(86400))), rest)


def _two(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def hhmmss(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    return F.concat(_two(F.floor(s / 3600)), _two(F.floor(s / 60) % 60), _two(s % 60))


def cut_time(seconds: Column) -> Column:
    """`HH:MM:SS.mmm`."""
    ms = F.round(seconds * 1000).cast("long")
    return F.concat(_two(F.floor(ms / 3600000)), F.lit(":"), _two(F.floor(ms / 60000) % 60), F.lit(":"), _two(F.floor(ms / 1000) % 60), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))


def iso_date(text: Column) -> Column:
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))


def iso_time(text: Column) -> Column:
    return F.concat_ws(":", F.substring(text, 1, 2), F.substring(text, 3, 2), F.substring(text, 5, 10))


def parse_date(text: Column, form: str = "yyyy/MM/dd") -> Column:
    """Null where the text isn't such a date, the sentinel 0000/00/00 included."""
    return F.try_to_date(text, form)


def roll_end_date(start_date: Column, start_time: Column, end_time: Column) -> Column:
    return F.when(end_time < start_time, F.date_add(start_date, 1)).otherwise(start_date)


def clock_ms(text: Column) -> Column:
    """`HHmmss[.f]` to ms of the day; null where it isn't one."""
    h, m, s, rest = _clock_parts(text)
    fraction = F.when(F.length(rest) > 1, F.round(rest.try_cast("double") * 1000).cast("long")).otherwise(F.lit(0))
    return (h * 3600 + m * 60 + s).cast("long") * 1000 + fraction


def exif_timestamp(day: Column, clock: Column, fallback: Column) -> Column:
    """Date `yyyy:MM:dd` and time `[h, m, s/k]`, else the capture stamp `yyyy:MM:dd HH:mm:ss`, else null."""
    parts = F.split(F.regexp_replace(clock, r"[\[\] ]", ""), ",")
    second = F.split(F.get(parts, F.lit(2)), "/")
    whole = F.floor(F.get(second, F.lit(0)).try_cast("double") / F.coalesce(F.get(second, F.lit(1)).try_cast("double"), F.lit(1.0))).cast("int")
    stamp = F.concat(day, F.lit(" "), _two(F.trim(F.get(parts, F.lit(0)))), F.lit(":"), _two(F.trim(F.get(parts, F.lit(1)))), F.lit(":"), _two(whole))
    form = F.lit("yyyy:MM:dd HH:mm:ss")
    return F.coalesce(F.try_to_timestamp(stamp, form), F.try_to_timestamp(fallback, form))


def grid_seed(ms: Column, step: int = 10) -> Column:
    """The nearest multiple of step."""
    return F.floor((ms + step // 2) / step).cast("long") * step
