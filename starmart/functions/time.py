"""The date and key expressions of ``sqltext`` as columns; arguments are SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starmart.functions import sqltext

NTZ = "timestamp_ntz"


def ntz(value) -> Column:
    return F.expr(sqltext.ntz(value))


def date_key(ts: str) -> Column:
    return F.expr(sqltext.date_key(ts))


def time_key(ts: str) -> Column:
    return F.expr(sqltext.time_key(ts))


def duration_sec(start: str, end: str) -> Column:
    return F.expr(sqltext.duration_sec(start, end))


def keys_to_timestamp(date: str, time: str) -> Column:
    return F.expr(sqltext.keys_to_timestamp(date, time))


def hour_start(ts: str) -> Column:
    return F.expr(sqltext.hour_start(ts))


def week_start(day: str, first: str = "monday") -> Column:
    return F.expr(sqltext.week_start(day, first))
