"""Change rows and type-2 history.

* ``snapshot_changes`` derives a change feed by diffing two versions of a
  keyed table: one full outer join on the key, null-safe comparison.
* ``scd2`` folds change rows into validity intervals per key, tolerant of
  late and out-of-order rows: the whole change set of a key is ordered by
  ``(sequence, delete-before-upsert, tiebreak)``, rows equal to their
  predecessor on the tracked columns are dropped, deletes end a version and
  are then removed (rulings R-9, R-21).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.contracts import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION
from rowgate.functions.timeexpr import ts

HOT_KEYS = 4096  # keys that are split by ranges at most
INSERT, DELETE = "insert", "delete"
PRE, POST = "update_preimage", "update_postimage"
UPSERT = "upsert"


def snapshot_changes(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    version: int,
    commit_ts,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Change rows between two versions of a keyed table.

    Inserts, deletes (keys gone from a full snapshot), and an
    ``update_preimage``/``update_postimage`` pair for every key whose
    columns differ (``IS DISTINCT FROM``).  Unchanged keys emit nothing.
    """
    keys = list(keys)
    others = [c for c in (columns or new.columns) if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in others], F.lit(True).alias("_in_old"))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in others], F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full_outer")
    in_old = F.coalesce(F.col("_in_old"), F.lit(False))
    in_new = F.coalesce(F.col("_in_new"), F.lit(False))
    if others:
        changed = reduce(or_, [~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in others])
    else:
        changed = F.lit(False)
    both = in_old & in_new & changed
    old_img = F.struct(
        F.when(~in_new, F.lit(DELETE)).when(both, F.lit(PRE)).alias(CHANGE_TYPE),
        *[F.col(f"_o_{c}").alias(c) for c in others],
    )
    new_img = F.struct(
        F.when(~in_old, F.lit(INSERT)).when(both, F.lit(POST)).alias(CHANGE_TYPE),
        *[F.col(f"_n_{c}").alias(c) for c in others],
    )
    commit = commit_ts.cast("timestamp_ntz") if isinstance(commit_ts, Column) else ts(commit_ts)
    return (
        j.filter(~in_old | ~in_new | changed)
        .select(*keys, F.inline(F.array(old_img, new_img)))
        .filter(F.col(CHANGE_TYPE).isNotNull())
        .select(
            *keys,
            *others,
            CHANGE_TYPE,
            F.lit(version).cast("bigint").alias(COMMIT_VERSION),
            commit.alias(COMMIT_TIMESTAMP),
        )
    )


def is_delete(change_type: Column) -> Column:
    """Apply-as-delete rule (C2).  Pre-images are dropped before folding (R-9),
    so only real deletes close a version here."""
    return change_type == DELETE


def net_changes(changes: DataFrame, keys: Sequence[str], seq: str = COMMIT_VERSION) -> DataFrame:
    """Last effective change per key over a change feed.

    Pre-images are ignored; at one sequence an upsert beats a delete.  The
    result is one row per key: its final image and whether it ends deleted.
    Planned as an aggregate, so a hot key is reduced map-side.
    """
    keys = list(keys)
    others = [c for c in changes.columns if c not in keys and c not in (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)]
    rows = changes.filter(F.col(CHANGE_TYPE) != PRE)
    rank = F.when(is_delete(F.col(CHANGE_TYPE)), F.lit(0)).otherwise(F.lit(1))
    top = rows.groupBy(*keys).agg(
        F.max(F.struct(F.col(seq).alias("_s"), rank.alias("_r"), F.col(CHANGE_TYPE).alias("_t"), *[F.col(c) for c in others])).alias("_top")
    )
    return top.select(
        *keys,
        *[F.when(F.col("_top._r") == 1, F.col(f"_top.{c}")).alias(c) for c in others],
        (F.col("_top._r") == 0).alias("is_deleted"),
        F.col("_top._s").alias(f"last{seq}" if seq.startswith("_") else f"last_{seq}"),
    )


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tracked: Sequence[str],
    change_type: str = CHANGE_TYPE,
    tiebreak: Sequence[str] = (),
    delete_when: Column | None = None,
    ignore_when: Column | None = None,
    split_rows: int = 1_000_000,
    split_ranges: int = 8,
) -> DataFrame:
    """Type-2 history (C3-C5, W2): ``keys``, tracked columns, ``valid_from``,
    ``valid_to`` (NULL while open) and ``is_current``.

    A new version starts only when a tracked column changes (C5, R-21); a
    delete closes the open version and a later upsert reopens the key.
    ``ignore_when`` drops rows before folding (default: update pre-images).

    Skew: rows are counted per key (map-side first).  Keys with more than
    ``split_rows`` rows, the ``HOT_KEYS`` largest of them, are cut into sequence
    ranges, one for every ``split_rows`` rows and ``split_ranges`` at least, at
    values of their own chosen by hash (any orderable type).  Windows run per
    (key, range), and ranges are stitched by carrying each one's last image and
    first start to its neighbour.  All other keys, also large ones beyond the
    ``HOT_KEYS`` largest, of which none has more than ``1 / HOT_KEYS`` of all rows,
    are one window each.  Either way gives the same rows; without hot keys adaptive
    execution drops their side of the plan.  Finding a row's range compares it
    with all cuts of its key, so raise ``split_rows`` along with keys of very many
    rows.  Only rows of one key with one sequence value are always together.
    """
    keys = list(keys)
    ct = F.col(change_type)
    delete_when = is_delete(ct) if delete_when is None else delete_when
    ignore_when = (ct == PRE) if ignore_when is None else ignore_when
    rows = changes.filter(~F.coalesce(ignore_when, F.lit(False))).withColumn(
        "_rg_del", F.coalesce(delete_when, F.lit(False))
    )
    # At one sequence a delete sorts before an upsert, so the upsert wins (R-9).
    rank = F.when(F.col("_rg_del"), 0).otherwise(1)
    image = F.struct(
        F.col("_rg_del").alias("_d"),
        *[F.when(F.col("_rg_del"), F.lit(None)).otherwise(F.col(c)).alias(c) for c in tracked],
    )
    rows = rows.select(*keys, *tracked, sequence_by, *tiebreak, "_rg_del", rank.alias("_rk"), image.alias("_img"))
    order = [F.col(sequence_by), F.col("_rk")] + [F.col(t) for t in tiebreak]
    bounded = _fold(rows, keys, sequence_by, tiebreak, order, split_rows, split_ranges)
    return bounded.filter(~F.col("_rg_del")).select(
        *keys,
        *tracked,
        F.col(sequence_by).alias("valid_from"),
        F.col("_next").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` in which NULL keys match each other."""
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(named, cond, how).drop(*[f"_r_{k}" for k in keys])


def _fold(rows, keys, seq, tiebreak, order, split_rows, split_ranges):
    """Starts of versions with the next start, ``_next``: hot keys by ranges, all others
    by one window a key."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > split_rows)
    # at most HOT_KEYS keys, so the hint has a bound; keys break ties, so both sides see one set
    hot = F.broadcast(sizes.orderBy(F.desc("_n"), *keys).limit(HOT_KEYS))
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = _null_safe(rows, hot, keys, "left_anti").withColumn("_prev", F.lag("_img").over(w))
    starts = marked.filter(~F.col("_img").eqNullSafe(F.col("_prev"))).drop("_prev")
    cold = starts.withColumn("_next", F.lead(seq).over(w))
    ranges = F.greatest(F.lit(split_ranges).cast("long"), F.ceil(F.col("_n") / max(1, split_rows)))
    split = _null_safe(rows, hot, keys, "inner").withColumn("_n", ranges)
    return cold.unionByName(_ranged(split, keys, seq, tiebreak, order))


def _ranged(rows, keys, seq, tiebreak, order):
    """Skew-safe lag/lead per key of rows with their key's number of ranges, ``_n``:
    (key, range) windows plus boundary carry."""
    # 1. cut points: per key and hash bucket the value with the smallest hash
    pick = F.xxhash64(seq)
    sample = rows.groupBy(*keys, F.pmod(pick, F.col("_n")).alias("_h")).agg(F.min(F.struct(pick.alias("h"), F.col(seq).alias("s"))).alias("_s"))
    cuts = sample.groupBy(*keys).agg(F.collect_set("_s.s").alias("_cuts"))
    # range = number of cut points <= seq: monotone in seq, equal seqs together
    rows = _null_safe(rows.drop("_n"), cuts, keys)
    rows = rows.withColumn("_b", F.coalesce(F.size(F.filter(F.col("_cuts"), lambda c: c <= F.col(seq))), F.lit(0))).drop("_cuts")
    part = [*keys, "_b"]
    w_in = Window.partitionBy(*part).orderBy(*order)
    w_b = Window.partitionBy(*keys).orderBy("_b")
    sort_key = F.struct(F.col(seq).alias("s"), F.col("_rk").alias("r"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tiebreak)])

    # 2. previous image: inside the range by lag, at a range start from the
    #    previous range's last image
    tails = rows.groupBy(*part).agg(F.max(F.struct(sort_key.alias("k"), F.col("_img").alias("img"))).alias("_t"))
    carry_in = tails.select(*part, F.lag(F.col("_t.img")).over(w_b).alias("_carry"))
    marked = rows.withColumn("_prev", F.lag("_img").over(w_in))
    marked = _null_safe(marked, carry_in, part).withColumn("_prev", F.coalesce(F.col("_prev"), F.col("_carry")))
    # a range's first row has a NULL in-range lag; the carry is NULL only for the key's first range
    starts = marked.filter(~F.col("_img").eqNullSafe(F.col("_prev"))).drop("_carry", "_prev")

    # 3. next start: inside the range by lead, at a range end from the next
    #    range that has a start
    heads = starts.groupBy(*part).agg(F.min(sort_key).alias("_h"))
    carry_out = heads.select(*part, F.lead(F.col("_h.s")).over(w_b).alias("_carry"))
    bounded = starts.withColumn("_next", F.lead(seq).over(w_in))
    bounded = _null_safe(bounded, carry_out, part).withColumn("_next", F.coalesce(F.col("_next"), F.col("_carry")))
    return bounded.drop("_carry", "_b")


def splice(
    history: DataFrame,
    rows: DataFrame,
    first: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tracked: Sequence[str],
    change_type: str = CHANGE_TYPE,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """``history`` with change rows put between their neighbours.

    ``first`` has a row for every key to change: ``keys`` and ``_from``, the sequence
    value of its earliest new row, or NULL to build the key anew.  ``rows`` are all
    change rows of those keys at or after it (all of the key's, where it is NULL), those
    that were folded before included.  Versions that ended before ``_from``, and keys
    that aren't in ``first``, stay as they are; the version open at ``_from`` is the
    predecessor and gets its end anew; later ones are folded from ``rows``.  So a key whose
    new rows all come after what is known needs nothing but its open version.  The result
    is ``scd2`` over all change rows of all times.  NULL keys match each other.
    """
    keys = list(keys)
    marked = _null_safe(history, first.select(*keys, "_from", F.lit(True).alias("_hit")), keys)
    before = F.coalesce(F.col("valid_from") < F.col("_from"), F.lit(False))
    ended = F.coalesce(F.col("valid_to") < F.col("_from"), F.lit(False))
    kept = marked.filter(F.col("_hit").isNull() | (before & ended)).select(*history.columns)
    named = {sequence_by: F.col("valid_from"), change_type: F.lit(UPSERT), **{t: F.lit(None) for t in tiebreak}}
    columns = [*keys, *tracked, *named]
    types = rows.select(*columns).schema
    open_then = marked.filter(F.col("_hit") & before & ~ended)
    seeds = open_then.select(*[named.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in types.fields])
    folded = scd2(seeds.unionByName(rows.select(*columns)), keys, sequence_by, tracked, change_type=change_type, tiebreak=tiebreak)
    return kept.unionByName(folded.select(*history.columns))


def current(history: DataFrame) -> DataFrame:
    """Current-row view."""
    return history.filter(F.col("valid_to").isNull())


def as_of(history: DataFrame, when) -> DataFrame:
    """Versions valid at ``when``: ``from <= t AND (to > t OR to IS NULL)``."""
    t = when.cast("timestamp_ntz") if isinstance(when, Column) else ts(when)
    return history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def days_active(history: DataFrame) -> DataFrame:
    """Days between the start and end dates of each version."""
    return history.withColumn("days_active", F.datediff(F.to_date("valid_to"), F.to_date("valid_from")))
