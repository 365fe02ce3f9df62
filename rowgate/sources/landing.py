"""Landing batches.

A landing root holds ``<area>/<yyyyMMdd_HHmmss>/**/*.parquet``.
``read_landing`` derives batch and area per row from ``_metadata.file_path``;
"the newest batch" of such a frame is an aggregate plus a join against a
one-row frame, which reads every batch.  ``read_newest`` picks the folder from
a listing instead and reads nothing else.

A folder may fill over time or be read in parts, so what has been loaded is told
file by file (``LandedFile``): by path below the landing root, size and time of
modification.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import BATCH_NAME_PATTERN
from rowgate.functions.timeexpr import batch_time, hours_between, ts

# The path from the area on, area and batch: files at any depth below a batch folder.  It
# starts at whole folder names only, so that its time follows the path's length.
_PATH_RE = r"(?:^|/)(([^/]+)/(\d{8}_\d{6})/.+)$"


def read_landing(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Read every batch under ``root`` with ``area`` and ``batch`` columns.

    Folder names that are not ``yyyyMMdd_HHmmss`` are ignored (R-17).
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(root)
    path = F.col("_metadata.file_path")
    return (
        df.withColumns(
            {"area": F.regexp_extract(path, _PATH_RE, 2), "batch": F.regexp_extract(path, _PATH_RE, 3)}
        )
        .filter(F.col("batch").rlike(BATCH_NAME_PATTERN))
    )


def _latest(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per ``by`` group with its newest batch name (text order)."""
    if by:
        return df.groupBy(*by).agg(F.max("batch").alias("batch"))
    return df.agg(F.max("batch").alias("batch"))


def latest_batch(df: DataFrame, area: str | None = None) -> DataFrame:
    """Rows of the newest batch, optionally within one area.

    Raises nothing on an empty input: the result is simply empty.
    """
    if area is not None:
        df = df.filter(F.col("area") == area)
    newest = _latest(df, [])
    return df.join(F.broadcast(newest), ["batch"], "left_semi")


def latest_per_area(df: DataFrame) -> DataFrame:
    """Rows of the newest batch of every area (S4); empty areas drop out."""
    # One row per landing area -- bounded by the number of area folders --
    # so it is broadcast: a whole batch (one join key) never becomes one
    # shuffle task.
    newest = F.broadcast(_latest(df, ["area"]))
    return df.join(newest, ["area", "batch"], "left_semi")


def batch_inventory(df: DataFrame, as_of) -> DataFrame:
    """All batches in time order with rows and hours since ``as_of``."""
    now = ts(as_of) if not hasattr(as_of, "_jc") else as_of
    return (
        df.groupBy("area", "batch")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("batch_time", batch_time(F.col("batch")))
        .withColumn("hours_since", hours_between(F.col("batch_time"), now))
    )


def unprocessed(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of batches not in the ledger of processed ``(area, batch)`` (S21, R-13).

    No hint: AQE broadcasts the ledger if it measures small, and else splits
    the partition of a batch that holds most rows.
    """
    done = ledger.select("area", "batch").distinct()
    return df.join(done, ["area", "batch"], "left_anti")


def ledger_from_sources(df: DataFrame, source_col: str = "source_file") -> DataFrame:
    """``area/batch`` strings (the ``source_file`` audit column) as a ledger."""
    parts = F.split(F.col(source_col), "/")
    return df.select(parts.getItem(0).alias("area"), parts.getItem(1).alias("batch")).distinct()


def schema_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Readability/schema probe against a contract (S5, V9), with the
    per-column null and castability counts of the whole frame.

    One aggregate over ``df``; the schema comparison itself is metadata.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(contract.fields):
        if f.name in actual:
            aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"))
            aggs.append(
                F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f"_b{i}")
            )
        else:
            aggs.append(F.lit(None).cast("bigint").alias(f"_n{i}"))
            aggs.append(F.lit(None).cast("bigint").alias(f"_b{i}"))
    stats = df.agg(*aggs)
    rows = []
    for i, f in enumerate(contract.fields):
        a = actual.get(f.name)
        status = "missing" if a is None else ("ok" if a == f.dataType else "type_mismatch")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(a.simpleString() if a is not None else None).cast("string").alias("actual_type"),
                F.lit(status).alias("status"),
                F.col(f"_n{i}").alias("null_rows"),
                F.col(f"_b{i}").alias("uncastable_rows"),
            )
        )
    extras = [n for n in actual if n not in {f.name for f in contract.fields}]
    for n in extras:
        rows.append(
            F.struct(
                F.lit(n).alias("column_name"),
                F.lit(None).cast("string").alias("expected_type"),
                F.lit(actual[n].simpleString()).alias("actual_type"),
                F.lit("extra").alias("status"),
                F.lit(None).cast("bigint").alias("null_rows"),
                F.lit(None).cast("bigint").alias("uncastable_rows"),
            )
        )
    return stats.select(F.col("_rows").alias("row_count"), F.inline(F.array(*rows)))


def require_latest_batch(df: DataFrame, area: str | None = None) -> str:
    """Name of the newest batch (S2); ``FileNotFoundError`` when there is none.

    One aggregate returning one value -- the only thing that reaches the
    driver.
    """
    if area is not None:
        df = df.filter(F.col("area") == area)
    newest = _latest(df, []).first()
    if newest is None or newest["batch"] is None:
        raise FileNotFoundError(f"no batch folder found{' in ' + area if area else ''}")
    return newest["batch"]


def is_readable(spark: SparkSession, path: str, contract: T.StructType | None = None) -> bool:
    """Readability probe (S5): the folder's parquet footers can be read and,
    if a contract is given, every contract column is present.  Reads
    metadata only."""
    try:
        schema = spark.read.parquet(path).schema
    except Exception:  # noqa: BLE001 - any read failure means "not readable"
        return False
    if contract is None:
        return True
    names = set(schema.fieldNames())
    return all(f.name in names for f in contract.fields)


def list_batches(spark: SparkSession, root: str, area: str) -> list[str]:
    """Batch folder names of one area, oldest first -- a folder listing
    through the Hadoop file system (any shared store), bounded by the number
    of folders.  Names that are not ``yyyyMMdd_HHmmss`` are skipped (R-17)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{area}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    pat = re.compile(BATCH_NAME_PATTERN)
    return sorted(st.getPath().getName() for st in fs.listStatus(path)
                  if st.isDirectory() and pat.match(st.getPath().getName()))


def read_newest(spark: SparkSession, root: str, area: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of an area's newest batch (S1 + S2) without touching older
    batches: the folder is chosen from the listing, then only it is read.
    ``FileNotFoundError`` when the area has no batch."""
    names = list_batches(spark, root, area)
    if not names:
        raise FileNotFoundError(f"no batch folder found in {area}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(f"{root.rstrip('/')}/{area}/{names[-1]}")
    return df.withColumns({"area": F.lit(area), "batch": F.lit(names[-1])})


class LandedFile(NamedTuple):
    """One file of a batch; ``file`` is its path from the area on, ``modified`` in milliseconds."""

    area: str
    batch: str
    file: str
    size: int
    modified: int


# What tells a file, as columns of a scan that hasn't been projected yet.  They stand on each
# of the file's rows, so nothing is made of the path before the rows are one a file.
def file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("modified"),
    ]


def landed_file(path: str, size: int, modified: int) -> LandedFile | None:
    """The file of a path; None if it isn't in a batch folder (R-17)."""
    m = re.search(_PATH_RE, path)
    return LandedFile(m[2], m[3], m[1], size, modified) if m else None


def list_files(spark: SparkSession, root: str, area: str, batch: str) -> list[LandedFile]:
    """The data files of one batch folder, at any depth, from a listing."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{area}/{batch}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while found.hasNext():
        st = found.next()
        f = landed_file(st.getPath().toUri().getPath(), st.getLen(), st.getModificationTime())
        if f and not any(part.startswith(("_", ".")) for part in f.file.split("/")[2:]):
            out.append(f)
    return sorted(out)


def read_files(spark: SparkSession, root: str, files: Sequence[LandedFile]) -> DataFrame:
    """Rows of the given files with the files' own columns and types.  A column whose type
    differs between files comes as text, so that the edge casts every value; a column
    that some files lack is null there.  Footers are read file by file."""
    if not files:
        raise ValueError("no files to read")
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for f in files:
        path = f"{root.rstrip('/')}/{f.file}"
        schema = spark.read.parquet(path).schema
        by_schema.setdefault(schema.json(), (schema, []))[1].append(path)
    groups = list(by_schema.values())
    kinds: dict[str, set[str]] = {}
    for schema, _ in groups:
        for f in schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    frames = [
        spark.read.schema(schema).parquet(*paths).select(*[F.col(f"`{c}`") if len(kinds[c]) == 1 else F.col(f"`{c}`").cast("string").alias(c) for c in schema.fieldNames()])
        for schema, paths in groups
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def new_files(files: Sequence[LandedFile], ledger: DataFrame) -> list[LandedFile]:
    """Those of ``files`` that the ledger doesn't have (S21); all files of a batch that it
    has as a whole are known.  Reads the ledger's rows of these batches only."""
    names = sorted({f"{f.area}/{f.batch}" for f in files})
    known = ledger.where(F.concat_ws("/", "area", "batch").isin(names)).select(*LandedFile._fields).collect()
    whole = {(r["area"], r["batch"]) for r in known if r["file"] is None}
    have = {tuple(r) for r in known}
    return [f for f in files if (f.area, f.batch) not in whole and tuple(f) not in have]
