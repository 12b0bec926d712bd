"""Predicates of pages and panels. An argument that isn't set (None or an empty text) is no condition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import expr


def org_filter(df: DataFrame, org: str | None = None, excluded: tuple[str, ...] = (), column: str = "org") -> DataFrame:
    """Rows of one org, without those whose org starts with an excluded prefix."""
    df = df.where(F.col(column) == org) if org else df
    return reduce(lambda d, p: d.where(~F.col(column).startswith(p)), excluded, df)


def half_open(df: DataFrame, column: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """start <= column < end."""
    df = df if start is None else df.where(F.col(column) >= start)
    return df if end is None else df.where(F.col(column) < end)


def equal_to(df: DataFrame, **values: object) -> DataFrame:
    """Equality for each value that is set."""
    return reduce(lambda d, kv: d.where(F.col(kv[0]) == kv[1]), ((k, v) for k, v in values.items() if v not in (None, "")), df)


def one_of(df: DataFrame, column: str, choices: str | None) -> DataFrame:
    """Rows whose value is in a comma-separated list; all rows for an empty one."""
    return df.where(F.col(column).isin([c.strip() for c in choices.split(",")])) if choices else df


def after_watermark(df: DataFrame, stamp: str, key: str, at: Column, last: Column) -> DataFrame:
    """Rows after (at, last) in the order of stamp and key."""
    return df.where((F.col(stamp) > at) | ((F.col(stamp) == at) & (F.col(key) > last)))


def nonblank(df: DataFrame, *columns: str) -> DataFrame:
    return reduce(lambda d, c: d.where(~expr.blank(F.col(c))), columns, df)


def like_any(column: str, patterns: list[str]) -> Column:
    """Whether the value is like any of the patterns, whatever the case; false for null."""
    return F.coalesce(reduce(lambda a, b: a | b, (F.col(column).ilike(p) for p in patterns), F.lit(False)), F.lit(False))


def settled_hours(df: DataFrame, hour: str, now: Column, minutes: int = 15) -> DataFrame:
    """Hours that ended at least ``minutes`` before ``now``."""
    return df.where(F.col(hour) < F.date_trunc("hour", now - F.make_interval(mins=F.lit(minutes))))


def fresh(df: DataFrame, stamp: str, now: Column, minutes: int) -> DataFrame:
    return df.where((F.col(stamp) > now - F.make_interval(mins=F.lit(minutes))) & (F.col(stamp) <= now))


def tail_window(df: DataFrame, stamp: str, now: Column, *, lateness_min: int, width_min: int) -> DataFrame:
    """The window that is computed again and again as time goes on: ``width_min`` minutes that end ``lateness_min`` before ``now``."""
    end = now - F.make_interval(mins=F.lit(lateness_min))
    return half_open(df, stamp, end - F.make_interval(mins=F.lit(width_min)), end)
