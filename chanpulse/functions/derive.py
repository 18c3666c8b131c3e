"""Scalar derivations (column expressions, all JVM-side, no UDF).

Each function returns a ``Column`` or a ``DataFrame -> DataFrame`` step so that
Catalyst keeps them inside whole-stage code generation and can prune or push
around them freely.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..schemas import PACE_DECIMAL, RATE_DECIMAL

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_literal(as_of: _dt.datetime | str | None) -> Column:
    """One fixed "now" per run, so every output of a run agrees (no
    ``current_timestamp`` re-evaluated per action)."""
    if as_of is None:
        as_of = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def parse_iso_timestamp(c: ColumnOrName) -> Column:
    """ISO-8601 text with ``Z`` or an offset -> timestamp; malformed -> NULL."""
    return _c(c).try_cast("timestamp")


def counter(c: ColumnOrName) -> Column:
    """Counter text -> bigint: 0 when absent, NULL when it is no number (see
    :func:`bad_counter`)."""
    return F.when(_c(c).isNull(), F.lit(0).cast("bigint")).otherwise(_c(c).try_cast("bigint"))


def bad_counter(c: ColumnOrName) -> Column:
    """A counter is there, but no number."""
    return _c(c).isNotNull() & _c(c).try_cast("bigint").isNull()


def per_view(numerator: Column, views: ColumnOrName) -> Column:
    """``numerator / views`` as double, 0.0 when views is 0, negative or NULL."""
    v = _c(views)
    return F.when(v > 0, numerator.cast("double") / v).otherwise(F.lit(0.0))


def engagement_rate(likes: ColumnOrName = "likes", comments: ColumnOrName = "comments",
                    views: ColumnOrName = "views") -> Column:
    return per_view(_c(likes) + _c(comments), views)


def likes_per_view(likes: ColumnOrName = "likes", views: ColumnOrName = "views") -> Column:
    return per_view(_c(likes), views)


def comments_per_view(comments: ColumnOrName = "comments",
                      views: ColumnOrName = "views") -> Column:
    return per_view(_c(comments), views)


def weekday_name(ts: ColumnOrName) -> Column:
    """English weekday name of the UTC time ("Saturday")."""
    return F.date_format(_c(ts), S.WEEKDAY_NAME_PATTERN)


def hour_of_day(ts: ColumnOrName) -> Column:
    return F.hour(_c(ts))


def publish_date(ts: ColumnOrName) -> Column:
    return F.to_date(_c(ts))


def day_of_week(ts: ColumnOrName) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(ts))


def month_key(ts: ColumnOrName) -> Column:
    """``yyyy-MM`` text."""
    return F.date_format(_c(ts), S.MONTH_KEY_PATTERN)


def month_start(month: ColumnOrName) -> Column:
    """First day of a ``yyyy-MM`` key as DATE (the dashboard's time axis)."""
    return F.to_date(F.concat(_c(month), F.lit("-01")))


def views_per_day(views: ColumnOrName, publish_time: ColumnOrName, as_of: Column) -> Column:
    """Views per day of age, whole seconds; 0 when no publish time, NULL when
    the age is zero (no division error); negative for future publish times."""
    pt = _c(publish_time)
    age_days = (F.unix_timestamp(as_of) - F.unix_timestamp(pt)) / F.lit(86400)
    return F.when(pt.isNull(), F.lit(0.0)).otherwise(F.try_divide(_c(views), age_days))


def with_publish_parts(df: DataFrame, ts: str = "publish_time") -> DataFrame:
    """publish_date, publish_day_of_week and publish_month from the UTC time."""
    return df.withColumns({
        "publish_date": publish_date(ts),
        "publish_day_of_week": day_of_week(ts),
        "publish_month": month_key(ts),
    })


def with_ingest_fields(df: DataFrame, ts: str = "publish_time") -> DataFrame:
    """Fields the ingest step derives per video: rate, weekday name, hour."""
    return df.withColumns({
        "engagement_rate": engagement_rate(),
        "publish_day": weekday_name(ts),
        "publish_hour": hour_of_day(ts),
    })


def with_video_metrics(df: DataFrame, as_of: Column) -> DataFrame:
    """The processed video frame: date parts plus per-view rates and pace."""
    return with_publish_parts(df).withColumns({
        "likes_per_view": likes_per_view(),
        "comments_per_view": comments_per_view(),
        "views_per_day": views_per_day("views", "publish_time", as_of),
    })


def narrow_to_table_types(df: DataFrame) -> DataFrame:
    """Rates to DECIMAL(10,6), pace to DECIMAL(15,2), half away from zero.

    For rows that passed the rules, which look at the wide values; a value out
    of range would become NULL here (``try_cast``)."""
    cols = {}
    for name in ("engagement_rate", "likes_per_view", "comments_per_view"):
        if name in df.columns:
            cols[name] = F.col(name).try_cast(RATE_DECIMAL)
    if "views_per_day" in df.columns:
        cols["views_per_day"] = F.col("views_per_day").try_cast(PACE_DECIMAL)
    return df.withColumns(cols) if cols else df


def with_defaults(df: DataFrame, defaults: dict[str, object], schema=None) -> DataFrame:
    """Add columns that the source lacks with their default value.  A column
    that is present keeps its NULLs (the NOT NULL rule reports them)."""
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    add = {}
    for name, value in defaults.items():
        if name not in df.columns:
            lit = F.lit(value)
            add[name] = lit.cast(types[name]) if name in types else lit
    return df.withColumns(add) if add else df


def minus_days(as_of: Column, days: int) -> Column:
    """``as_of - INTERVAL n DAYS`` (constant interval arithmetic)."""
    return as_of - F.make_interval(days=F.lit(days))
