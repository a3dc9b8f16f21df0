"""Timestamps: strict RFC 3339 input and millisecond differences."""

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3339 = r"\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})"


def parse_rfc3339(text: Column) -> Column:
    """NULL unless the text carries a full date, a time and an offset.

    A plain cast would also take a bare year or a time without an offset. Digits past the sixth
    are dropped, since timestamps hold microseconds.
    """
    return F.when(text.rlike(rf"^{RFC3339}\z"), F.upper(text).try_cast("timestamp"))


def utc_instant(ts: Column) -> Column:
    """The instant of a wall-clock time in UTC, whatever the zone of the session."""
    seconds = (
        F.unix_date(ts.cast("date")).cast("bigint") * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    )
    return F.timestamp_micros(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))


def utc_wall_clock(ts: Column) -> Column:
    """The wall-clock time in UTC of an instant, whatever the zone of the session."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    nothing = F.lit(0)
    since = F.make_dt_interval(nothing, nothing, nothing, seconds)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def int_div(dividend: Column, divisor: Column | int) -> Column:
    """Integer division, truncating towards zero."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor).cast("bigint")
    return F.call_function("div", dividend, divisor)


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds from start to end, 0 when start lies after end."""
    micros = epoch_micros(end) - epoch_micros(start)
    return F.greatest(int_div(micros, 1000), F.lit(0).cast("bigint"))
