"""Spark SQL text of the date, key and number expressions.

Arguments are SQL expressions. One text per expression keeps plan building cheap: a whole query is one
call into the JVM instead of one per operator and literal. Date and time keys are integer arithmetic
inside whole-stage codegen: no formatting to text and no detour over the session time zone.
"""

from __future__ import annotations


def ntz(value) -> str:
    """A literal (text or datetime) as a zone-less timestamp."""
    return f"timestamp_ntz'{value}'"


def date_key(ts: str) -> str:
    """yyyyMMdd as int."""
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))"


def time_key(ts: str) -> str:
    """HHmmss as int; leading zeros are lost (05:00:03 is 50003)."""
    return f"(hour({ts}) * 10000 + minute({ts}) * 100 + second({ts}))"


def duration_sec(start: str, end: str) -> str:
    """Difference of the whole epoch seconds; negative when the end lies before the start."""
    return f"cast(unix_timestamp({end}) - unix_timestamp({start}) as int)"


def key_hour(key: str) -> str:
    return f"cast({key} div 10000 as int)"


def valid_time_key(key: str) -> str:
    """True for a key that names a second of the day; NULL for a NULL key."""
    return f"({key} between 0 and 235959 and {key} div 100 % 100 < 60 and {key} % 100 < 60)"


def _stamp(date: str, hour: str, minute: str, second: str) -> str:
    day = f"cast({date} div 10000 as int), cast({date} div 100 % 100 as int), {date} % 100"
    return f"try_make_timestamp_ntz({day}, {hour}, {minute}, {second})"


def keys_to_timestamp(date: str, time: str) -> str:
    """Timestamp of a date key and a time key; NULL if either is NULL or names no day or second."""
    minute, second = f"cast({time} div 100 % 100 as int)", f"cast({time} % 100 as decimal(16,6))"
    return f"case when {valid_time_key(time)} then {_stamp(date, key_hour(time), minute, second)} end"


def keys_to_hour(date: str, hour: str) -> str:
    """Start of an hour from a date key and the hour of day; NULL for a key that names no day."""
    return _stamp(date, hour, "0", "0.0")


def key_to_date(date: str) -> str:
    return f"cast({_stamp(date, '0', '0', '0.0')} as date)"


def hour_start(ts: str) -> str:
    return f"make_timestamp_ntz(year({ts}), month({ts}), day({ts}), hour({ts}), 0, 0.0)"


def week_start(day: str, first: str = "monday") -> str:
    """First day of the week as a date; weeks begin on ``monday`` or ``sunday``."""
    day = f"cast({day} as date)"
    if first == "monday":
        return f"date_sub({day}, weekday({day}))"
    if first == "sunday":
        return f"date_sub({day}, dayofweek({day}) - 1)"
    raise ValueError(f"first must be 'monday' or 'sunday', not {first!r}")


def rounded(value: str, digits: int) -> str:
    """Round half away from zero on the decimal value, so 1.005 becomes 1.01; the result is double."""
    return f"cast(round(cast({value} as decimal(28,8)), {digits}) as double)"


def ratio(part: str, whole: str) -> str:
    """Quotient as double; NULL instead of an error when the divisor is zero."""
    return f"(cast({part} as double) / nullif(cast({whole} as double), 0))"


def mean(column: str) -> str:
    """Average as exact sum over count, NULL for an empty or all-NULL group."""
    return ratio(f"sum({column})", f"count({column})")
