"""Integrity rules (NOT NULL, ranges, lengths, decimal fit, uniqueness) and
the freshness check.

A rule is a name plus a boolean "violated" expression.  All rules of a table
are evaluated in one pass: ``violation_counts`` is one global aggregate of
``count_if`` per rule (partial per task), ``flag`` tags rows for quarantine.
Uniqueness is a grouped count on the keys (map-side combine first).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType

from .. import schemas as S
from ..session import materialise
from .filters import fresh_counts
from .upsert import duplicate_keys


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column
    column: str | None = None  # the column it looks at
    required: bool = False     # an absent column violates it


class RuleViolation(ValueError):
    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        bad = ", ".join(f"{k}={v}" for k, v in counts.items() if v)
        super().__init__(f"rule violations: {bad}")


def not_null(columns: list[str]) -> list[Rule]:
    return [Rule(f"not_null_{c}", F.col(c).isNull(), c, required=True) for c in columns]


def in_range(column: str, lo, hi) -> Rule:
    c = F.col(column)
    return Rule(f"range_{column}", c.isNotNull() & ((c < lo) | (c > hi)), column)


def max_length(column: str, n: int) -> Rule:
    c = F.col(column)
    return Rule(f"length_{column}", c.isNotNull() & (F.char_length(c) > n), column)


def fits(column: str, dt: DataType | str, name: str | None = None) -> Rule:
    """The value converts to ``dt`` without overflow (e.g. DECIMAL(10,6))."""
    c = F.col(column)
    return Rule(name or f"fits_{column}", c.isNotNull() & c.try_cast(dt).isNull(), column)


def int32(column: str) -> Rule:
    c = F.col(column)
    return Rule(f"int32_{column}", c.isNotNull() & ((c < S.INT32_MIN) | (c > S.INT32_MAX)), column)


def video_rules() -> list[Rule]:
    rules = not_null(S.VIDEO_NOT_NULL)
    rules += [in_range("publish_hour", *S.HOUR_RANGE),
              in_range("publish_day_of_week", *S.WEEKDAY_RANGE)]
    rules += [max_length(c, S.TEXT_LIMITS[c]) for c in ("video_id", "publish_day", "publish_month")]
    rules += [fits(c, S.RATE_DECIMAL) for c in ("engagement_rate", "likes_per_view",
                                                "comments_per_view")]
    rules += [fits("views_per_day", S.PACE_DECIMAL), int32("likes"), int32("comments")]
    return rules


def channel_rules() -> list[Rule]:
    rules = not_null(S.CHANNEL_NOT_NULL)
    rules += [max_length(c, S.TEXT_LIMITS[c]) for c in ("channel_id", "channel_title")]
    rules += [int32("video_count")]
    return rules


def applicable(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules as they hold for ``df``: every row breaks the NOT NULL rule of
    a column that ``df`` lacks; a range or length of such a column holds."""
    have = set(df.columns)
    out = []
    for r in rules:
        if r.column is None or r.column in have:
            out.append(r)
        elif r.required:
            out.append(Rule(r.name, F.lit(True), None, True))
    return out


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row, one column per rule: the number of violating rows."""
    return df.agg(*[F.count_if(r.violated).alias(r.name) for r in rules])


@dataclass(frozen=True)
class Profile:
    rows: int
    counts: dict[str, int]
    parts: list  # distinct partition values (None for a NULL one)


def profile(df: DataFrame, rules: list[Rule], partition: Column | None = None) -> Profile:
    """Row count, violating rows per rule and the distinct values of
    ``partition`` in one global aggregate (partial per task, so one row per
    task is shuffled).  The set of partition values is bounded by the
    table's partition count (months), not by the batch."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(r.violated).alias(r.name) for r in rules]
    if partition is not None:
        aggs += [F.collect_set(partition).alias("_parts"),
                 F.count_if(partition.isNull()).alias("_null_parts")]
    r = df.agg(*aggs).first().asDict()
    parts = list(r.get("_parts") or [])
    if r.get("_null_parts"):
        parts.append(None)
    return Profile(int(r["_rows"] or 0), {x.name: int(r[x.name] or 0) for x in rules}, parts)


def flag(df: DataFrame, rules: list[Rule], column: str = "violations") -> DataFrame:
    """Add a comma-separated list of the rules a row breaks ("" if none)."""
    names = [F.when(r.violated, F.lit(r.name)) for r in rules]
    return df.withColumn(column, F.concat_ws(",", *names))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their ``violations``).

    The flagged rows are written once: both halves are read several times (repeats, profile,
    merge, whoever looks at the rows set aside), and a filter on ``violations`` that reaches
    the source would work out every rule on every derived column again, each time.  Columns
    without a type, which no file holds, are added anew."""
    flagged = flag(df, rules)
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
    flagged = materialise(flagged.drop(*void), "flagged").withColumns(
        {c: F.lit(None) for c in void}).select(*flagged.columns)
    good = flagged.filter(F.col("violations") == "").drop("violations")
    bad = flagged.filter(F.col("violations") != "")
    return good, bad


REPEATED = "repeated_key"


def set_aside_repeats(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key occurs once, rows of repeated keys with ``violations``).

    Which of a key's rows is right can't be told, so all of them are set aside.  Keys are
    counted by a partial aggregate; the repeated ones (keys alone, written once) are joined
    back by a semi and an anti join, which adaptive execution splits where one key is hot."""
    repeated = materialise(duplicate_keys(df, keys).select(*keys), "repeated-keys")
    bad = df.join(repeated, keys, "left_semi").select(*df.columns)
    good = df.join(repeated, keys, "left_anti").select(*df.columns)
    return good, bad.withColumn("violations", F.lit(REPEATED))


def check_freshness(channels: DataFrame, videos: DataFrame, as_of: Column,
                    days: int = S.FRESH_DAYS, video_column: str = "created_at") -> dict:
    """Raise when no channel snapshot (checked first) or no video row is
    newer than ``as_of - days``; else return both counts."""
    r = fresh_counts(channels, videos, as_of, days, video_column).first()
    if not r["recent_channels"]:
        raise ValueError("No recent channel data found")
    if not r["recent_videos"]:
        raise ValueError("No recent video data found")
    return {"recent_channels": int(r["recent_channels"]),
            "recent_videos": int(r["recent_videos"])}
