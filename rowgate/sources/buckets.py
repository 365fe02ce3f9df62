"""Key-hash bucketed state: a step that changes a few keys writes only their buckets.

A table is a parquet folder ``<path>/v=N/bucket=B`` with
``bucket = pmod(xxhash64(keys), n)``; version N holds the buckets that step N
changed.  Its map ``<path>_map/v=N`` names the version that holds each bucket,
its rows and a digest of them, by which a step that brings the whole table anew
finds the buckets that changed.
A step writes its buckets, then its map, and the map's success marker commits
the step: nothing that a committed map names is ever overwritten, so a step
that broke off anywhere is run again from the map before it.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.sources import tables

BUCKET = "rg_bucket"
_MAP = T.StructType([T.StructField(c, T.LongType()) for c in ("bucket", "version", "rows", "buckets", "xor_a", "xor_b")])
_FOLDER = re.compile(r"^(?:v|rg_bucket)=(\d+)$")


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def dealt(df: DataFrame, keys: Sequence[str], n: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """``df`` with its bucket, ready to be written by bucket.  The rebalance gives a
    bucket few files; adaptive execution splits one that is large over several tasks."""
    return df.withColumn(BUCKET, bucket_of(keys, n)).hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *sort_by)


@dataclass
class Layout:
    """A map: how many buckets there are, (version, rows) of those that aren't empty, and
    their digests where they were taken."""

    buckets: int = 0
    held: dict[int, tuple[int, int]] = field(default_factory=dict)
    digests: dict[int, tuple[int, int, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.held.values())


def layout(spark: SparkSession, path: str, max_version: int | None = None) -> Layout:
    """The newest map (a row a bucket)."""
    root, name = path.rsplit("/", 1)
    found = tables.read(spark, root, f"{name}_map", _MAP, max_version=max_version).collect()
    return Layout(
        found[0]["buckets"] if found else 0,
        {r["bucket"]: (r["version"], r["rows"]) for r in found},
        {r["bucket"]: (r["rows"], r["xor_a"], r["xor_b"]) for r in found if r["xor_a"] is not None},
    )


def _digest(columns: Sequence[str]) -> list[Column]:
    """Rows, and the exclusive or of two hashes of each: the same for the same rows in any
    order (keys are unique, so no row cancels another).  Columns go by name; a null is told
    from a value, so a column more or less makes another digest."""
    flat = [c for name in sorted(columns) for c in (F.col(name), F.col(name).isNull())]
    return [F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*flat)).alias("xor_a"), F.bit_xor(F.xxhash64(F.lit("b"), *reversed(flat))).alias("xor_b")]


def differing(df: DataFrame, keys: Sequence[str], lay: Layout) -> list[int]:
    """The buckets of ``lay`` whose rows aren't those of ``df`` (at most ``lay.buckets``); ones
    without a digest always differ."""
    made = df.withColumn(BUCKET, bucket_of(keys, lay.buckets)).groupBy(BUCKET).agg(*_digest(df.columns)).collect()
    new = {r[0]: tuple(r)[1:] for r in made}
    return sorted(b for b in new.keys() | lay.held.keys() if b not in new or new[b] != lay.digests.get(b))


def hit_by(df: DataFrame, keys: Sequence[str], n: int) -> list[int]:
    """The buckets of a frame's keys (at most ``n``)."""
    return sorted(r[0] for r in df.select(bucket_of(keys, n).alias(BUCKET)).distinct().collect())


def paths(path: str, lay: Layout, hit: Collection[int] | None = None) -> list[str]:
    """The folders of the given buckets, or of all."""
    return [f"{path}/v={v:06d}/{BUCKET}={b}" for b, (v, _) in sorted(lay.held.items()) if hit is None or b in hit]


def versions_in_use(path: str, lay: Layout) -> list[str]:
    """A bucket's folder of each version that a map names."""
    return list({v: f"{path}/v={v:06d}/{BUCKET}={b}" for b, (v, _) in lay.held.items()}.values())


def read(spark: SparkSession, path: str, schema: T.StructType, lay: Layout, hit: Collection[int] | None = None) -> DataFrame:
    """Rows of the given buckets, or all; no other folder is listed."""
    found = paths(path, lay, hit)
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def replace(df: DataFrame, keys: Sequence[str], n: int, path: str, version: int, lay: Layout, hit: Collection[int], sort_by: Sequence[str] = (), digest: bool = False) -> Layout:
    """Put ``df`` in place of the buckets ``hit`` of the table that ``lay`` maps; the
    new map.  A bucket of which ``df`` has no rows becomes empty.  ``digest`` takes those of
    the written buckets, by reading them once."""
    spark, (root, name) = df.sparkSession, path.rsplit("/", 1)
    tables.write(dealt(df, keys, n, sort_by), root, name, version=version, partition_by=[BUCKET])
    with_bucket = T.StructType(df.schema.fields + [T.StructField(BUCKET, T.IntegerType())])
    what = _digest(df.columns) if digest else [F.count(F.lit(1)).alias("rows")]
    made = spark.read.schema(with_bucket).parquet(f"{path}/v={version:06d}").groupBy(BUCKET).agg(*what).collect()
    held = {b: x for b, x in lay.held.items() if b not in hit} | {r[0]: (version, r[1]) for r in made}
    digests = {b: x for b, x in lay.digests.items() if b not in hit} | ({r[0]: tuple(r)[1:] for r in made} if digest else {})
    rows = [(b, v, c, n, *digests.get(b, (c, None, None))[1:]) for b, (v, c) in sorted(held.items())]
    tables.write(spark.createDataFrame(rows, _MAP).coalesce(1), root, f"{name}_map", version=version)
    return Layout(n, held, digests)


def drop_superseded(spark: SparkSession, path: str, max_version: int) -> None:
    """Delete the bucket folders, and the maps, that neither of the two newest maps
    up to ``max_version`` names.  What is left is at most two folders a bucket."""
    root, name = path.rsplit("/", 1)
    maps = [v for v in tables.versions(spark, root, f"{name}_map") if v <= max_version]
    if len(maps) < 3:
        return
    keep = {(b, x[0]) for v in maps[-2:] for b, x in layout(spark, path, v).held.items()}
    for v, folder in _folders(spark, path):
        if v <= maps[-1]:
            inside = _folders(spark, folder)
            gone = [f for b, f in inside if (b, v) not in keep]
            for f in [folder] if len(gone) == len(inside) and v not in {p[1] for p in keep} else gone:
                _delete(spark, f)
    for v, folder in _folders(spark, f"{path}_map"):
        if v < maps[-2]:
            _delete(spark, folder)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    fs, p = _fs(spark, path)
    found = [(_FOLDER.match(s.getPath().getName()), s.getPath().toString()) for s in fs.listStatus(p)]
    return [(int(m[1]), f) for m, f in found if m]


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
