"""Streamed landing (Q49): the partial-load router inside ``foreachBatch``
over a file stream of ``<area>/<yyyyMMdd_HHmmss>/*.parquet`` batches.

Each micro-batch may carry several landing batches; they are routed oldest
first so a later batch sees the keys an earlier one quarantined (R4).  The
stamp time of a batch is its folder time, so re-running gives the same rows.
State is the jobs' ``State`` pinned at the micro-batch id: reads see
versions ``<= batch_id`` and every write is version ``batch_id + 1``,
replaced on retry, so the sink is idempotent.  Each micro-batch also
publishes the clean table's change rows for the keys it touched, which the
history stream can consume.

The stream itself carries the files' identities only; each micro-batch reads its
files with their own columns and types, so files of other types or with further
columns go through the same edge as in the jobs.  What has been routed is told file
by file: a folder may come in several micro-batches or be completed later.  Parts of
a folder count as loaded one after the other.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowgate.contracts import Params
from rowgate.sources.landing import file_columns, landed_file

# A schema that no file has a column of.
_NO_COLUMN = T.StructType([T.StructField("_rg_none", T.BooleanType())])


class LandingRouter:
    def __init__(self, root: str, landing_root: str, data_schema: T.StructType, params: Params = Params()):
        self.root = root
        self.landing_root = landing_root
        self.data_schema = data_schema
        self.params = params

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from rowgate.plans.jobs import State, route_files

        st = State(batch.sparkSession, self.root, self.data_schema, self.params, at=batch_id)
        # Only the files' identities reach the driver (at most the micro-batch's files).
        found = [landed_file(*r) for r in batch.select("path", "size", "modified").distinct().collect()]
        files = [f._replace(file=unquote(f.file)) for f in found if f]  # as listings have them
        route_files(st, self.landing_root, files)


def landing_stream(spark: SparkSession, landing_root: str, max_files: int | None = None) -> DataFrame:
    """Landing files as a stream of what tells them, a row for each of their rows (no
    column is read); at most ``max_files`` files a micro-batch."""
    reader = spark.readStream.schema(_NO_COLUMN).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing_root).select(*file_columns())


def start(spark: SparkSession, router: LandingRouter, checkpoint: str, every: str | None = None, max_files: int | None = None):
    """The running query: all files that are there (``availableNow``), or, with
    ``every`` (such as "1 minute"), new ones as they land, until it is stopped."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        landing_stream(spark, router.landing_root, max_files)
        .writeStream.foreachBatch(router)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_available(spark: SparkSession, router: LandingRouter, checkpoint: str, max_files: int | None = None) -> None:
    q = start(spark, router, checkpoint, max_files=max_files)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
