"""A lattice of column types (S9, S10): what a table's column becomes when batches
bring it with different types.

``wider`` goes up only as far as parquet files of the narrower type can be read as the
wider one: TINYINT < SMALLINT < INT < BIGINT, integers < DECIMAL with room for all their
digits, DECIMAL < DECIMAL, FLOAT < DOUBLE, integers up to INT < DOUBLE, DATE <
TIMESTAMP_NTZ.  A column that a schema lacks doesn't hold the others back; its rows read
as NULL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {"tinyint": 10, "smallint": 10, "int": 10, "bigint": 20}  # as the reader wants them


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """(digits before the point, after it) that a decimal needs for ``t``."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_DIGITS[t.simpleString()], 0) if t in _INTEGERS else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds both, or None."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    x, y = _decimal(a), _decimal(b)
    if x and y:
        before, after = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    pair = {a, b}
    if T.DoubleType() in pair and pair & {T.FloatType(), *_INTEGERS[:3]}:
        return T.DoubleType()
    return T.TimestampNTZType() if pair == {T.DateType(), T.TimestampNTZType()} else None


def merged(schemas: Iterable[T.StructType]) -> T.StructType:
    """The columns of all schemas in the order they come, each with the least type that
    holds all of its own.  ``ValueError``: a column has types that don't meet."""
    out: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            t = wider(out[f.name], f.dataType) if f.name in out else f.dataType
            if t is None:
                raise ValueError(f"column {f.name}: {out[f.name].simpleString()} and {f.dataType.simpleString()} don't go into one type")
            out[f.name] = t
    return T.StructType([T.StructField(name, t) for name, t in out.items()])
