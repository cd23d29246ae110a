"""Time, number, cast and null columns (F14-F21, F27, F28), and when they are computed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a load shorter than this counts as this long.
MIN_RATE_MS = 1000

SECONDS_PER_DAY = 86_400
WEEKDAYS = "MonTueWedThuFriSatSun"


def written_moment(value: Column) -> Column:
    """the moment of ``Thu Feb 23 13:32:22 +0000 2017``, null for an impossible date; the
    weekday is not looked at."""
    return F.try_to_timestamp(F.substring(value, 5, 64), F.lit("MMM dd HH:mm:ss Z yyyy"))


def on_its_day(value: Column, moment: Column) -> Column:
    """P5: the moment written in ``value``, null for a weekday that does not belong to the date.

    The weekday is that of the written date, so it is reckoned from the seconds at the
    written offset.
    """
    hours, minutes = F.substring(value, 22, 2).try_cast("int"), F.substring(value, 24, 2).try_cast("int")
    ahead = F.when(F.substring(value, 21, 1) == "-", -1).otherwise(1) * (hours * 3600 + minutes * 60)
    day = F.floor((F.unix_seconds(moment) + ahead) / SECONDS_PER_DAY)
    # Day 0 was a Thursday.
    weekday = F.substring(F.lit(WEEKDAYS), (F.pmod(day + 3, F.lit(7)) * 3 + 1).cast("int"), F.lit(3))
    return F.when(F.substring(value, 1, 4) == F.concat(weekday, F.lit(" ")), moment)


def post_time(value: Column) -> Column:
    """``Thu Feb 23 13:32:22 +0000 2017`` to a timestamp, else null.

    Null for an impossible date and for a weekday that does not belong to the date.
    """
    return on_its_day(value, written_moment(value))


def clock_text(moment: Column) -> Column:
    """F16: time of day with milliseconds."""
    return F.date_format(moment, "HH:mm:ss.SSS")


def epoch_seconds(moment: Column) -> Column:
    """whole seconds since 1970."""
    return F.unix_timestamp(moment)


def epoch_millis_time(value: Column) -> Column:
    """a text of milliseconds since 1970 to a timestamp, else null."""
    return F.timestamp_millis(value.try_cast("bigint"))


def int_div(left: Column, right: Column) -> Column:
    """whole-number division."""
    return F.call_function("div", left, right)


def rate_per_second(rows: Column, elapsed_ms: Column) -> Column:
    """Rows per whole second, with a floor on the time."""
    return int_div(rows, int_div(F.greatest(elapsed_ms, F.lit(MIN_RATE_MS)), F.lit(1000)))


def as_long(value: Column) -> Column:
    """try-parse to a 64-bit number, null when it is none."""
    return value.try_cast("bigint")


def or_zero(value: Column) -> Column:
    """The default of an absent number."""
    return F.coalesce(value, F.lit(0))


def or_false(value: Column) -> Column:
    """The default of an absent flag."""
    return F.coalesce(value, F.lit(False))


def evaluated_once(value: Column) -> Column:
    """The value, computed once per row however often it is used later.

    The optimizer copies a plain expression into every filter and projection
    that mentions it, so a line would be parsed once per mention. It does not
    merge a generator, here of one element, with its neighbours.
    """
    return F.explode(F.array(value))
