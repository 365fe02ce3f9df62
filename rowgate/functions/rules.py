"""Row checks as Catalyst expressions.

A rule is a pair ``(code, failed)`` where ``failed`` is a boolean Column that
is true when the row breaks the rule.  Everything stays a JVM expression so
the checks run inside whole-stage codegen and never leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.contracts import BAD_TYPE_CODE_PREFIX, NULL_CODE_PREFIX, REASON_SEPARATOR

Rule = tuple[str, Column]


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Argument guard: fail before any plan is built (V9)."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"a DataFrame is needed here, not {type(df).__name__}")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the batch lacks the columns {sorted(missing)}")


def null_rules(required: Sequence[str]) -> list[Rule]:
    """``null_<c>`` for every required column, in the given order (V1)."""
    return [(f"{NULL_CODE_PREFIX}{c}", F.col(c).isNull()) for c in required]


def type_rules(casts: dict[str, tuple[str, str]]) -> list[Rule]:
    """``bad_type_<target>`` when the source is present but does not cast.

    ``casts`` maps target column -> (source column, Spark type name).
    """
    return [
        (f"{BAD_TYPE_CODE_PREFIX}{target}", F.col(src).isNotNull() & F.col(src).try_cast(typ).isNull())
        for target, (src, typ) in casts.items()
    ]


def any_failed(rules: Sequence[Rule]) -> Column:
    """OR of all rule predicates (V2); false when there are no rules."""
    if not rules:
        return F.lit(False)
    return reduce(or_, [pred for _, pred in rules])


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def error_codes(rules: Sequence[Rule]) -> Column:
    """Array of codes of the failed rules, in rule order; ``[]`` when clean (V3)."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(pred, F.lit(code)) for code, pred in rules]))


def reason_text(errors: Column) -> Column:
    """Human-readable reason: the codes joined by ', ' (V5)."""
    return F.concat_ws(REASON_SEPARATOR, errors)


def render_codes(errors: Column, sep: str = ",") -> Column:
    """String form of an error array, for reports and oracle comparison."""
    return F.array_join(errors, sep)
