"""Quarantine lifecycle (L1-L17, J5, J6) as next-state functions.

Every function takes the current state frames and one ``as_of`` and returns
new frames; nothing is updated in place (there is no mutable table format),
so a pass is computed from one consistent input and written afterwards
(ruling R-8).  Status updates are ``when`` expressions over a keyed flag
join, never ``isin`` lists collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.contracts import (
    BLOCKED,
    EXPIRED,
    FIXED,
    QUARANTINE,
    RELEASED,
    Params,
)
from rowgate.functions.rules import all_present
from rowgate.functions.timeexpr import plus_hours, ts
from rowgate.operators.keyed import anti, flag_membership, key_set, latest_per_key, semi, upsert

STATUS = "quarantine_status"
_FLAG = "_rg_member"
# Newest first; ties broken by ingestion time, batch and then all columns (R-7).
ROW_ORDER = ("quarantine_timestamp", "ingestion_timestamp", "source_file")


def _now(as_of) -> Column:
    return as_of.cast("timestamp_ntz") if isinstance(as_of, Column) else ts(as_of)


def is_live(params: Params = Params()) -> Column:
    return F.col(STATUS).isin(*params.live)


def data_columns(quarantine: DataFrame, params: Params = Params()) -> list[str]:
    from rowgate.contracts import QUARANTINE_METADATA_COLUMNS

    if params.columns:
        return list(params.columns)
    return [c for c in quarantine.columns if c not in QUARANTINE_METADATA_COLUMNS and c != "moved_to_dead_letter"]


def _set_status(df: DataFrame, cond: Column, status: str, bump_attempts: bool = False) -> DataFrame:
    cols = {STATUS: F.when(cond, F.lit(status)).otherwise(F.col(STATUS))}
    if bump_attempts:
        cols["fix_attempts"] = F.when(cond, F.col("fix_attempts") + 1).otherwise(F.col("fix_attempts"))
    return df.withColumns(cols)


# --- L1-L5: fixed rows and release -----------------------------------------

def fixed_rows(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """Live rows whose every required column (and key) is present (L1)."""
    return quarantine.filter(is_live(params) & all_present(list(params.required_with_keys())))


def fixed_keys(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    return key_set(fixed_rows(quarantine, params), params.keys)


def mark_fixed(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """All live rows of a fixed key -> FIXED, ``fix_attempts + 1`` (L2)."""
    q = flag_membership(quarantine, fixed_keys(quarantine, params), params.keys, _FLAG)
    return _set_status(q, F.col(_FLAG) & is_live(params), FIXED, bump_attempts=True).drop(_FLAG)


def latest_valid_per_key(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """Newest *valid* live row of each fixed key (L3 with ruling R-5)."""
    cols = data_columns(quarantine, params)
    rows = fixed_rows(quarantine, params)
    return latest_per_key(rows.select(*cols, *ROW_ORDER), params.keys, ROW_ORDER)


def release_fixed(clean: DataFrame, quarantine: DataFrame, params: Params = Params(), released: DataFrame | None = None):
    """``detect_and_release_fixed_records``.

    Returns ``(clean', quarantine', released)``: the newest valid row per
    fixed key is merged into the clean table (R-6: upsert, not append) and
    every live row of those keys ends RELEASED with one more fix attempt.
    A job may pass ``released`` already written to storage; its keys are
    exactly the fixed keys, so they drive the status update too.
    """
    cols = data_columns(quarantine, params)
    if released is None:
        released = latest_valid_per_key(quarantine, params).select(*cols)
        marked = mark_fixed(quarantine, params)
    else:
        q = flag_membership(quarantine, released.select(*params.keys), params.keys, _FLAG)
        marked = _set_status(q, F.col(_FLAG) & is_live(params), FIXED, bump_attempts=True).drop(_FLAG)
    q2 = _set_status(marked, F.col(STATUS) == FIXED, RELEASED)
    c2 = upsert(clean, released, params.keys, dedupe_order=None)
    return c2, q2, released


# --- L6-L9: expiry -----------------------------------------------------------

def expired_predicate(as_of, params: Params = Params()) -> Column:
    return is_live(params) & (F.col("quarantine_expiry") < _now(as_of))


def dead_letter_rows(quarantine: DataFrame, as_of, params: Params = Params()) -> DataFrame:
    """Live rows past expiry, as dead-letter rows (L6, R-10: status EXPIRED)."""
    return (
        quarantine.filter(expired_predicate(as_of, params))
        .withColumn(STATUS, F.lit(EXPIRED))
        .withColumn("moved_to_dead_letter", _now(as_of))
    )


def mark_expired(quarantine: DataFrame, as_of, params: Params = Params()) -> DataFrame:
    """Same predicate, same ``as_of`` -> EXPIRED (L7, R-8)."""
    return _set_status(quarantine, expired_predicate(as_of, params), EXPIRED)


def expire(quarantine: DataFrame, dead_letter: DataFrame | None, as_of, params: Params = Params()):
    """``move_expired_to_dead_letter`` (L8) -> ``(quarantine', dead_letter', moved)``."""
    moved = dead_letter_rows(quarantine, as_of, params)
    dl = moved if dead_letter is None else dead_letter.unionByName(moved, allowMissingColumns=True)
    return mark_expired(quarantine, as_of, params), dl, moved


def expired_by_reason(moved: DataFrame) -> DataFrame:
    """Count of moved rows per reason, largest first."""
    return moved.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("row_count")).orderBy(
        F.desc("row_count"), F.asc("quarantine_reason")
    )


# --- L10: promote blocked ------------------------------------------------------

def promotable_rows(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """BLOCKED rows whose key has no QUARANTINE row any more."""
    q_keys = key_set(quarantine.filter(F.col(STATUS) == QUARANTINE), params.keys)
    return anti(quarantine.filter(F.col(STATUS) == BLOCKED), q_keys, params.keys)


def promoted_rows(quarantine: DataFrame, params: Params = Params()) -> DataFrame:
    """Newest BLOCKED row of every promotable key."""
    cols = data_columns(quarantine, params)
    rows = promotable_rows(quarantine, params)
    return latest_per_key(rows.select(*cols, *ROW_ORDER), params.keys, ROW_ORDER).select(*cols)


def promote_blocked(clean: DataFrame, quarantine: DataFrame, params: Params = Params(), promoted: DataFrame | None = None):
    """``promote_blocked_records`` -> ``(clean', quarantine', promoted)``.

    Newest BLOCKED row per promotable key is merged into the clean table and
    every BLOCKED row of those keys becomes RELEASED.  ``promoted`` may be
    passed in already written (its keys are the promotable keys).
    """
    if promoted is None:
        promoted = promoted_rows(quarantine, params)
    q = flag_membership(quarantine, promoted.select(*params.keys), params.keys, _FLAG)
    q2 = _set_status(q, F.col(_FLAG) & (F.col(STATUS) == BLOCKED), RELEASED).drop(_FLAG)
    c2 = upsert(clean, promoted, params.keys, dedupe_order=None)
    return c2, q2, promoted


# --- manual repair (J5, J6, L11-L14) --------------------------------------------

def apply_corrections(quarantine: DataFrame, corrections: DataFrame, params: Params = Params()) -> DataFrame:
    """MERGE corrections into live rows on the key.

    Only the columns present in ``corrections`` are replaced; released or
    expired rows are left alone.  ``corrected`` marks the touched rows.
    """
    keys = list(params.keys)
    upd = [c for c in corrections.columns if c not in keys]
    corr = latest_per_key(corrections, keys, ()).select(
        *keys, *[F.col(c).alias(f"_c_{c}") for c in upd], F.lit(True).alias(_FLAG)
    )
    j = quarantine.join(corr, keys, "left")
    hit = F.coalesce(F.col(_FLAG), F.lit(False)) & is_live(params)
    out = [F.when(hit, F.col(f"_c_{c}")).otherwise(F.col(c)).alias(c) if c in upd else F.col(c) for c in quarantine.columns]
    return j.select(*out, hit.alias("corrected"))


def fill_defaults(quarantine: DataFrame, defaults: Mapping[str, object], params: Params = Params()) -> DataFrame:
    """``coalesce(col, default)`` on live rows only."""
    return quarantine.withColumns(
        {c: F.when(is_live(params), F.coalesce(F.col(c), F.lit(v))).otherwise(F.col(c)) for c, v in defaults.items()}
    )


def mark_released(quarantine: DataFrame, keys_df: DataFrame, params: Params = Params()) -> DataFrame:
    """``UPDATE ... SET status = RELEASED WHERE key IN (subquery)`` on live rows."""
    q = flag_membership(quarantine, key_set(keys_df, params.keys), params.keys, _FLAG)
    return _set_status(q, F.col(_FLAG) & is_live(params), RELEASED).drop(_FLAG)


def recover_dead_letter(dead_letter: DataFrame, as_of, params: Params = Params()) -> DataFrame:
    """Dead-letter rows back into quarantine with a fresh clock."""
    now = _now(as_of)
    return dead_letter.drop("moved_to_dead_letter").withColumns(
        {
            "quarantine_timestamp": now,
            "quarantine_expiry": plus_hours(now, params.hours),
            STATUS: F.lit(QUARANTINE),
            "ingestion_timestamp": now,
        }
    )


def delete_keys(clean: DataFrame, bad: DataFrame, params: Params = Params()) -> DataFrame:
    """``DELETE FROM clean WHERE key IN (bad keys)``."""
    return anti(clean, key_set(bad, params.keys), params.keys)


def keep_keys(df: DataFrame, keys_df: DataFrame, params: Params = Params()) -> DataFrame:
    return semi(df, key_set(keys_df, params.keys), params.keys)


# --- L17: the maintenance pass ---------------------------------------------------

def maintenance_pass(
    clean: DataFrame,
    quarantine: DataFrame,
    dead_letter: DataFrame | None,
    as_of,
    params: Params = Params(),
    order: Sequence[str] = ("expire", "release", "promote"),
) -> dict:
    """Compose expire / release / promote in the given order (R-19).

    All steps see one ``as_of``.  Returns the final frames and the rows each
    step produced; ``summary`` is a one-row frame of their sizes.
    """
    state = {"clean": clean, "quarantine": quarantine, "dead_letter": dead_letter}
    produced: dict[str, DataFrame] = {}
    for step in order:
        if step == "expire":
            state["quarantine"], state["dead_letter"], produced["expired"] = expire(
                state["quarantine"], state["dead_letter"], as_of, params
            )
        elif step == "release":
            state["clean"], state["quarantine"], produced["released"] = release_fixed(
                state["clean"], state["quarantine"], params
            )
        elif step == "promote":
            state["clean"], state["quarantine"], produced["promoted"] = promote_blocked(
                state["clean"], state["quarantine"], params
            )
        else:
            raise ValueError(f"unknown step {step!r}")
    state.update(produced)
    return state
