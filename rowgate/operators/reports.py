"""Monitoring reports.

Each report is one aggregate (partial aggregation map-side, one shuffle on
the group key) or one top-k (``TakeOrderedAndProject``: per-partition top-k,
then a merge of k rows per partition).  No report collects an unbounded
group: where the reference gathers all ids of a reason or all versions of
a key into one array, we return one row per member (H7) or bounded
summaries (H9) instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import (
    ALERT_THRESHOLD,
    ALL_STATUSES,
    EXPIRED,
    EXPIRING_HORIZON_HOURS,
    RELEASED,
    REPORT_SIZE,
    Params,
)
from rowgate.functions.timeexpr import hours_between, plus_hours, ts

STATUS = "quarantine_status"


def _now(as_of) -> Column:
    return as_of.cast("timestamp_ntz") if isinstance(as_of, Column) else ts(as_of)


def _live(params: Params) -> Column:
    return F.col(STATUS).isin(*params.live)


def status_breakdown(quarantine: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """H1: rows and distinct keys per status."""
    return quarantine.groupBy(STATUS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("unique_ids"),
    )


def health_row(quarantine: DataFrame, params: Params = Params(), threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """H2 + H3: one row, a count for every status (zero when absent, R-18),
    the total, the live total and the high-volume alert flag."""
    counts = {s.lower(): F.count_if(F.col(STATUS) == s) for s in ALL_STATUSES}
    row = quarantine.agg(*[v.alias(k) for k, v in counts.items()], F.count(F.lit(1)).alias("total"))
    live = sum((F.col(s.lower()) for s in params.live), F.lit(0))
    return row.withColumns({"live_total": live, "high_volume_alert": live > F.lit(threshold)})


def with_hours_remaining(quarantine: DataFrame, as_of) -> DataFrame:
    return quarantine.withColumn("hours_remaining", hours_between(_now(as_of), F.col("quarantine_expiry")))


def expiring(
    quarantine: DataFrame,
    as_of,
    params: Params = Params(),
    horizon_hours: int | None = EXPIRING_HORIZON_HOURS,
    lower_bound: bool = True,
    limit: int | None = REPORT_SIZE,
    tiebreak: Sequence[str] = ("id", "name", "age"),
) -> DataFrame:
    """H4 (``now < expiry < now + 6h``, top 10), H4b (no lower bound) and
    H5 (no window, no limit), ordered by expiry then a total tiebreak."""
    now = _now(as_of)
    cond = _live(params)
    if horizon_hours is not None:
        cond = cond & (F.col("quarantine_expiry") < plus_hours(now, horizon_hours))
    if lower_bound:
        cond = cond & (F.col("quarantine_expiry") > now)
    out = with_hours_remaining(quarantine.filter(cond), as_of)
    ordered = out.orderBy(F.col("quarantine_expiry").asc(), *[F.col(c).asc_nulls_last() for c in tiebreak])
    return ordered.limit(limit) if limit else ordered


def top_reasons(quarantine: DataFrame, params: Params = Params(), limit: int = REPORT_SIZE) -> DataFrame:
    """H6: live rows per (status, reason): rows and distinct keys, top 10."""
    return (
        quarantine.filter(_live(params))
        .groupBy(STATUS, "quarantine_reason")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(*params.keys).alias("unique_ids"))
        .orderBy(F.desc("row_count"), F.asc(STATUS), F.asc_nulls_last("quarantine_reason"))
        .limit(limit)
    )


def reason_members(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """H7 without the unbounded ``collect_list(distinct id)``: one row per
    (reason, key) with the reason's row count attached."""
    live = quarantine.filter(_live(params))
    # One row per reason: AQE broadcasts the counts if they measure small, and
    # else splits the partition of a reason that holds most rows.
    counts = live.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("row_count"))
    members = live.filter(F.col(params.keys[0]).isNotNull()).select("quarantine_reason", *params.keys).distinct()
    return members.join(counts, ["quarantine_reason"], "inner")


def oldest_live(
    quarantine: DataFrame,
    as_of,
    params: Params = Params(),
    limit: int = REPORT_SIZE,
    tiebreak: Sequence[str] = ("id", "name", "age"),
) -> DataFrame:
    """H8: live rows by age in hours, oldest first, top 10."""
    return (
        quarantine.filter(_live(params))
        .withColumn("hours_quarantined", hours_between(F.col("quarantine_timestamp"), _now(as_of)))
        .orderBy(F.col("quarantine_timestamp").asc(), *[F.col(c).asc_nulls_last() for c in tiebreak])
        .limit(limit)
    )


def stacked_keys(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """H9: keys with more than one quarantine row.  Instead of collecting every
    version, report bounded summaries: count, first/last time, and the set of
    statuses seen (at most six values)."""
    k = list(params.keys)
    return (
        quarantine.filter(F.col(k[0]).isNotNull())
        .groupBy(*k)
        .agg(
            F.count(F.lit(1)).alias("version_count"),
            F.min("quarantine_timestamp").alias("first_seen"),
            F.max("quarantine_timestamp").alias("last_seen"),
            F.array_join(F.sort_array(F.collect_set(STATUS)), ",").alias("statuses"),
        )
        .filter(F.col("version_count") > 1)
    )


def daily_trend(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """Per quarantine date, rows, released, expired and still live."""
    return quarantine.groupBy(F.to_date("quarantine_timestamp").alias("quarantine_date")).agg(
        F.count(F.lit(1)).alias("quarantined_count"),
        F.count_if(F.col(STATUS) == RELEASED).alias("released_count"),
        F.count_if(F.col(STATUS) == EXPIRED).alias("expired_count"),
        F.count_if(_live(params)).alias("live_count"),
    )


def reason_counts(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """L9 + H12: rows per reason for expired rows and for live rows."""
    group = F.when(F.col(STATUS) == EXPIRED, F.lit("expired")).when(_live(params), F.lit("live"))
    return (
        quarantine.withColumn("row_group", group)
        .filter(F.col("row_group").isNotNull())
        .groupBy("row_group", "quarantine_reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def key_trail(quarantine: DataFrame, params: Params = Params(), min_rows: int = 2) -> DataFrame:
    """Every row of the keys that have several rows, in time order."""
    k = list(params.keys)
    multi = quarantine.filter(F.col(k[0]).isNotNull()).groupBy(*k).count().filter(F.col("count") >= min_rows)
    return quarantine.join(multi.select(*k), k, "left_semi")


def one_row(**frames: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side, like scalar subqueries.

    Each frame becomes one struct column of a union (the other slots NULL),
    and a single global aggregate picks the non-null slot of each -- no join,
    so nothing is paired.
    """
    items = list(frames.values())
    slots = []
    for i, df in enumerate(items):
        slots.append((f"_s{i}", T.StructType(df.schema.fields), df.columns))
    parts = []
    for i, df in enumerate(items):
        cols = []
        for j, (name, st, _) in enumerate(slots):
            cols.append((F.struct(*df.columns) if i == j else F.lit(None).cast(st)).alias(name))
        parts.append(df.select(*cols))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.agg(*[F.max(name).alias(name) for name, _, _ in slots])
    return agg.select(*[F.col(f"{name}.{c}").alias(c) for name, _, cs in slots for c in cs])


def quality_rate(clean: DataFrame, quarantine: DataFrame, dead_letter_count: DataFrame, params: Params = Params()) -> DataFrame:
    """H10 + H19: clean, live and dead counts, total and clean percentage
    (divide-by-zero guarded, R-20)."""
    c = clean.agg(F.count(F.lit(1)).alias("clean_count"))
    q = quarantine.agg(F.count_if(_live(params)).alias("live_quarantine"))
    m = one_row(c=c, q=q, d=dead_letter_count)
    total = F.col("clean_count") + F.col("live_quarantine") + F.col("dead_letter_count")
    return m.withColumns(
        {
            "total_processed": total,
            "quality_rate_pct": F.round(F.col("clean_count") * 100.0 / F.nullif(total, F.lit(0)), 2).cast("double"),
        }
    )


def frame_profile(df: DataFrame) -> DataFrame:
    """H16 extended: rows, column count and null count per column, from one
    aggregate; then unpivoted to one row per column."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stacked = agg.select(
        F.col("_rows").alias("row_count"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)])),
    )
    return stacked.withColumn("column_count", F.lit(len(cols)))
