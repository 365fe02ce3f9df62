"""Keyed building blocks shared by routing, lifecycle and history.

All of them are written so that one very hot key (say a third of all rows)
does not land whole in a single task:

* ``latest_per_key`` is an aggregate (``max`` of an ordering struct), which
  Spark evaluates map-side first, so each map task sends at most one row per
  key to the shuffle;
* membership tests (semi / anti / flag joins) join a big side with a
  *distinct* key set, without a hint: Catalyst's estimate counts compressed
  file bytes and is no bound, so AQE decides from the measured size at run
  time -- broadcast, or a shuffle join whose skewed partitions of the big
  side it splits (``spark.sql.adaptive.skewJoin.enabled``);
* ``upsert`` is an anti join on the source's keys plus a union, so the
  (large) target table streams through without a shuffle when the source
  is a small batch, and joins on unique keys otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "_rg_hit"


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null keys of ``df`` (U2).  Null keys never join (R-2)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond).select(*keys).distinct()


def flag_membership(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add boolean ``flag`` = key of the row is in ``keys_df`` (V7).

    ``keys_df`` must already be distinct; a left equi-join plus
    ``coalesce(hit, false)`` is null-safe (a null key is simply not a member),
    unlike ``isin`` with a null in the list.
    """
    marked = keys_df.select(*keys).withColumn(_HIT, F.lit(True))
    return df.join(marked, list(keys), "left").withColumn(flag, F.coalesce(F.col(_HIT), F.lit(False))).drop(_HIT)


def semi(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keys_df.select(*keys), list(keys), "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys_df``.  ``keys_df`` must hold no null
    keys; rows of ``df`` with a null key are kept (they match nothing)."""
    return df.join(keys_df.select(*keys), list(keys), "left_anti")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row per key: order by ``order`` descending, then by every other
    column descending as a total tiebreak (R-7).  Nulls rank lowest.

    Same result as ``row_number() over (partition by keys order by ... desc) = 1``
    but planned as an aggregate, so a hot key is reduced map-side.
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    top = df.groupBy(*keys).agg(F.max(_order_struct(order, columns)).alias("_top"))
    return top.select(*keys, *_unpack(order, columns))


def _order_struct(order: Sequence[str | Column], columns: Sequence[str]) -> Column:
    """``struct(order..., other columns...)``: its max is the newest row."""
    fields = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    named = {o for o in order if isinstance(o, str)}
    fields += [F.col(c) for c in columns if c not in named]
    return F.struct(*fields)


def _unpack(order: Sequence[str | Column], columns: Sequence[str]) -> list[Column]:
    pos = {o: i for i, o in enumerate(order) if isinstance(o, str)}
    return [F.col(f"_top._o{pos[c]}" if c in pos else f"_top.{c}").alias(c) for c in columns]



def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    dedupe_order: Sequence[str | Column] | None = (),
) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL.

    Target rows whose key is not in the source, plus every source row.  The
    source is first reduced to one row per key (R-16); pass
    ``dedupe_order=None`` when it is known to be unique.  Source rows with a
    null key match nothing and are inserted.  Columns only in the source are
    added (schema evolution); a matched row takes the source row whole.
    """
    if dedupe_order is not None:
        source = latest_per_key(source, keys, dedupe_order)
    kept = anti(target, source.select(*keys).filter(_all_keys(keys)), keys)
    return kept.unionByName(source, allowMissingColumns=True)


def _all_keys(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    count_col: str | None = None,
) -> DataFrame:
    """Duplicate detection and keep-latest in one aggregate.

    One row per key, the newest by ``order`` (then all other columns) and,
    if ``count_col`` is given, how many rows the key had.
    """
    if count_col is None:
        return latest_per_key(df, keys, order)
    columns = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max(_order_struct(order, columns)).alias("_top"), F.count(F.lit(1)).alias(count_col))
    return top.select(*keys, *_unpack(order, columns), count_col)
