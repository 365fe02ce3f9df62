"""Shared helpers: whole-text columns in and out of Arrow-batched tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII A-Z to a-z, and every ASCII character that is neither a letter nor a
# digit to a space; UTF-8 bytes from 0x80 on stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def folded_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return text.translate(FOLD).split()


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    return [b if b is not None else b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or with underscores added until no column has that name (Spark
    compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


class _Annotate:
    """Adds a struct column made by ``fn(texts) -> arrays``, batch by batch."""

    def __init__(self, text_col: str, into: str, schema: T.StructType, make: Callable, args: tuple):
        self.text_col, self.into, self.schema, self.make, self.args = text_col, into, schema, make, args

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        fn = self.make(*self.args)
        kinds = [pa.field(f.name, to_arrow_type(f.dataType)) for f in self.schema.fields]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                got = fn(utf8(part, self.text_col))
                arrays = [pa.array(v, type=k.type) for v, k in zip(got, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.StructArray.from_arrays(arrays, fields=kinds)], names=[*part.schema.names, self.into]
                )


def annotate(df: DataFrame, text_col: str, into: str, fields: str, make: Callable, *args) -> DataFrame:
    """``df`` with one struct column ``into`` (a name not yet taken).

    ``make(*args)`` is called once per task and returns a function from a list
    of UTF-8 texts to one list per field of ``fields`` (a DDL string).  Rows
    stay where they are: no shuffle.
    """
    schema = T.StructType.fromDDL(fields)
    out = T.StructType([*df.schema.fields, T.StructField(into, schema, True)])
    return df.mapInArrow(_Annotate(text_col, into, schema, make, args), out)


def row_key(*cols: Column) -> Column:
    """128 bits that tell rows with different values apart, nulls included."""
    flat = [c for col in cols for c in (F.coalesce(col.cast("string"), F.lit("")), col.isNull())]
    return F.struct(F.xxhash64(*flat).alias("a"), F.xxhash64(F.lit("second"), *reversed(flat)).alias("b"))


def first_rows(df: DataFrame, by: list[str], order: list[Column], most: int, rank: str, salts: int = 64) -> DataFrame:
    """The first ``most`` rows of each group with their ``rank`` from 1, in two steps: the
    first of each of ``salts`` parts of a group, then the first of those.  No task gets
    more of a group than one part, or ``salts * most`` rows."""
    salt, n = free_name(df, "salt"), free_name(df, rank)
    dealt = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    some = dealt.withColumn(n, F.row_number().over(Window.partitionBy(*by, salt).orderBy(*order))).where(F.col(n) <= most).drop(n, salt)
    return some.withColumn(n, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(n) <= most)
