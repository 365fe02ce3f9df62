"""Table state as versioned parquet snapshots.

There is no mutable table format here: a table is a folder of versions
``<root>/<name>/v=NNNNNN``; a write always creates the next version and a
read takes the newest committed one (a ``_SUCCESS`` marker is present).
Reading a version that does not exist yet yields an empty frame of the
contract schema (ruling R-4), so first runs need no special case.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.functions.widen import merged

_V = re.compile(r"^v=(\d+)$")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a contract: contract order, explicit casts,
    missing columns as typed NULLs (S12-S16; the edge where type drift such
    as INT vs BIGINT is settled)."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A created-but-empty table of the contract (``CREATE TABLE IF NOT EXISTS``)."""
    return spark.createDataFrame([], schema)


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Committed versions of a table, oldest first (listing via Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        m = _V.match(st.getPath().getName())
        if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def read(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType,
    version: int | None = None,
    max_version: int | None = None,
    evolve: bool = False,
) -> DataFrame:
    """Newest (or a given, or the newest ``<= max_version``) version; an
    empty contract frame if there is none (S6, R-4).  ``evolve`` adds the
    columns that the files have beyond ``schema`` (S9, S10)."""
    if version is None:
        vs = [v for v in versions(spark, root, name) if max_version is None or v <= max_version]
        if not vs:
            return empty(spark, schema)
        version = vs[-1]
    path = f"{root.rstrip('/')}/{name}/v={version:06d}"
    return spark.read.schema(grown(spark, [path], schema) if evolve else schema).parquet(path)


def grown(spark: SparkSession, folders: list[str], schema: T.StructType) -> T.StructType:
    """``schema`` and the further columns of the versions in ``folders``, with types that
    hold those of all versions (``ValueError`` where none does).  One job writes a version,
    so its files have one schema and one footer of each folder is read."""
    files = [f for f in (_a_file(spark, x) for x in folders) if f]
    if not files:  # a version without rows may have no file
        return schema
    try:
        found = [spark.read.option("mergeSchema", "true").parquet(*files).schema]
    except (PySparkException, Py4JJavaError):  # types that differ
        found = [spark.read.parquet(f).schema for f in files]
    have = {*schema.fieldNames(), "v", "terminal"}
    more = merged(T.StructType([f for f in x.fields if f.name not in have]) for x in found)
    return T.StructType(schema.fields + more.fields)


def children(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds that isn't hidden: folders or files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    return [p.toString() for p in found if not p.getName().startswith(("_", "."))]


def _a_file(spark: SparkSession, folder: str) -> str | None:
    """Any data file below a folder (or the file itself)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listFiles(path, True) if fs.exists(path) else None
    while found and found.hasNext():
        at = found.next().getPath()
        if at.getName().endswith(".parquet"):
            return at.toString()
    return None


def read_parts(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType,
    where: str | None = None,
    extra: T.StructType | None = None,
    max_version: int | None = None,
    evolve: bool = False,
    with_version: bool = False,
) -> DataFrame:
    """Every committed version of an append-style table at once (each
    version holds only the rows added by its step).  Uncommitted folders
    of a failed attempt are pruned by the version list.  ``with_version`` adds
    each row's version, ``v``."""
    vs = [v for v in versions(spark, root, name) if max_version is None or v <= max_version]
    if not vs:
        return empty(spark, T.StructType([*schema.fields, T.StructField("v", T.LongType())]) if with_version else schema)
    base = f"{root.rstrip('/')}/{name}"
    if evolve:
        schema = grown(spark, [f"{base}/v={v:06d}" for v in vs], schema)
    full = T.StructType(schema.fields + (extra.fields if extra else []) + [T.StructField("v", T.LongType())])
    df = spark.read.schema(full).parquet(f"{root.rstrip('/')}/{name}").filter(F.col("v").isin(vs))
    if where is not None:
        df = df.filter(where)
    return df.select(*[f.name for f in schema.fields], *(["v"] if with_version else []))


def write(
    df: DataFrame,
    root: str,
    name: str,
    cluster_by: list[str] | None = None,
    version: int | None = None,
    observe: tuple | None = None,
    partition_by: list[str] | None = None,
) -> int:
    """Write ``df`` as a version and return its number.

    Without ``version`` the number after the newest committed one is taken; a
    folder that a crashed write left there is replaced.  With ``version``
    (jobs: the pinned run, streaming: the batch id) the folder is replaced, so
    a retry rewrites the same result instead of appending twice.  Never overwrites what is being read.
    ``cluster_by`` range-partitions and sorts on the key before writing (the
    z-order layout hint, C10), so key lookups and joins prune row groups.
    ``observe = (Observation, exprs)`` is attached after that shuffle, where
    the plan runs exactly once (the range sampler re-runs what is below it).
    """
    spark = df.sparkSession
    if version is None:
        vs = versions(spark, root, name)
        version = (vs[-1] + 1) if vs else 1
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root.rstrip('/')}/{name}/v={version:06d}")
    return version
