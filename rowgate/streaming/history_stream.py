"""Streaming type-2 history.

The change feed arrives as parquet files (the output of
``snapshot_changes`` or any CDC export).  Each micro-batch is folded into
the history with ``foreachBatch``:

1. append the batch to the change log (one folder per batch id, split by
   key-hash bucket);
2. note each touched key's earliest new sequence value, and whether it is late: not
   after the last one that was seen of the key;
3. splice: a key whose rows are in order is carried on from its open version, without
   the log; for late keys the log is read from the earliest new row on, in their buckets;
4. write the touched buckets of the history as a new version: what ended before the new
   rows as it was, plus what was folded; the map of buckets commits it.

The stored table holds the versions and one row a key (``rg_seen``) with the last
sequence value seen, deletes and repeats included; a key one of whose rows had no sequence
value is always built anew from its whole log.

A micro-batch reads the map before its own and writes folders of its own batch
id only, so a retried one (after an executor or driver loss) produces the same
state; the stream's own checkpoint records which files were consumed.  Reads
come from written parquet, so lineage never grows across batches.  What a
micro-batch writes follows the buckets it touches: with keys spread evenly these are
soon all, unless there are many more buckets than keys in a batch.  Rows of a key must
differ in sequence value, in deleting or not, or in the tiebreak; the order of others
is undefined.
"""

from __future__ import annotations

import copy
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.functions.widen import merged
from rowgate.operators.history import PRE, _null_safe, splice
from rowgate.sources import buckets, tables

SEEN = "rg_seen"


class HistoryFold:
    """The ``foreachBatch`` function; all state lives under ``root``.

    Both the change log and the history are partitioned by a key-hash
    ``bucket``; a micro-batch reads the history of the buckets it touches and the
    log of those with late keys, and replaces only the former.  ``n_buckets``
    stays as it is for the life of a state; one bucket for every few GB of
    history keeps a micro-batch's reads small.
    """

    def __init__(
        self,
        root: str,
        keys: Sequence[str],
        sequence_by: str,
        tracked: Sequence[str],
        change_type: str,
        tiebreak: Sequence[str],
        change_schema: T.StructType,
        history_schema: T.StructType,
        n_buckets: int = 64,
    ):
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.sequence_by = sequence_by
        self.tracked = list(tracked)
        self.change_type = change_type
        self.tiebreak = list(tiebreak)
        self.change_schema = change_schema
        self.history_schema = history_schema
        self.n_buckets = n_buckets
        self.own: HistoryFold | None = None  # of a fold that has grown: as it was made

    @property
    def log_path(self) -> str:
        return f"{self.root}/change_log"

    @property
    def history_path(self) -> str:
        return f"{self.root}/history"

    @property
    def stored_schema(self) -> T.StructType:
        last = self.change_schema[self.sequence_by].dataType
        seen = T.StructType([T.StructField("last", last), T.StructField("without", T.BooleanType())])
        return T.StructType([*self.history_schema.fields, T.StructField(SEEN, seen)])

    def grown(self, spark: SparkSession, source_dir: str) -> "HistoryFold":
        """This fold with the further columns that the files in ``source_dir`` have (tracked
        too) and the widest types of any.  What was stored without a column reads as NULL."""
        own = self.own or self
        n = len(own.change_schema.fields)
        found = tables.grown(spark, tables.children(spark, source_dir), own.change_schema)
        more = merged(T.StructType(s.fields[n:]) for s in (self.change_schema, found)).fields
        out = copy.copy(self)
        out.own = own
        out.change_schema = T.StructType(own.change_schema.fields + more)
        out.tracked = own.tracked + [f.name for f in more]
        out.history_schema = T.StructType(own.history_schema.fields + more)
        return out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, keys = batch.sparkSession, self.keys
        cols = [f.name for f in self.change_schema.fields]
        # 1. the batch's rows into the log, replacing an earlier attempt of the same batch
        part = f"{self.log_path}/batch_id={batch_id:09d}"
        rows = buckets.dealt(batch.select(*cols), keys, self.n_buckets)
        rows.write.mode("overwrite").partitionBy(buckets.BUCKET).parquet(part)
        with_bucket = T.StructType([*self.change_schema.fields, T.StructField(buckets.BUCKET, T.IntegerType())])
        this = spark.read.schema(with_bucket).parquet(part)
        hit = sorted(r[0] for r in this.select(buckets.BUCKET).distinct().collect())
        if not hit:
            return
        # the batches before this one have ended, so what they replaced can go
        buckets.drop_superseded(spark, self.history_path, batch_id)
        lay = buckets.layout(spark, self.history_path, batch_id)
        old = buckets.read(spark, self.history_path, self.stored_schema, lay, hit)
        # 2. a row for each touched key, kept for the steps that need it
        touched = self._touched(this, old.filter(F.col(SEEN).isNotNull()))
        touched.write.mode("overwrite").parquet(f"{self.root}/touched")
        touched = spark.read.schema(touched.schema).parquet(f"{self.root}/touched")
        # 3. rows at or after each key's earliest new one: of late keys from the log
        late = touched.filter("_late").agg(F.collect_set(buckets.BUCKET), F.min("_from"), F.max(F.col("_from").isNull())).first()
        rows = this
        if late[0]:
            keyed = touched.select(*keys, "_from", "_late")
            rows = _null_safe(this, keyed.filter(~F.col("_late")), keys, "left_semi").select(*cols)
            log = self._log_since(spark, batch_id, sorted(late[0]), None if late[2] else late[1])
            again = _null_safe(log, keyed.filter("_late"), keys, "inner")
            again = again.filter(F.col("_from").isNull() | (F.col(self.sequence_by) >= F.col("_from")))
            rows = rows.unionByName(again.select(*cols))
        versions = splice(old.filter(F.col(SEEN).isNull()).drop(SEEN), rows, touched, keys, self.sequence_by,
                          self.tracked, change_type=self.change_type, tiebreak=self.tiebreak)
        # 4. the touched buckets, with what has been seen of each key
        seen = old.filter(F.col(SEEN).isNotNull()).select(*keys, f"{SEEN}.*")
        seen = seen.unionByName(touched.select(*keys, F.col("_last").alias("last"), F.col("_without").alias("without")))
        seen = seen.groupBy(*keys).agg(F.max("last").alias("last"), F.max("without").alias("without"))
        seen = seen.select(*keys, F.struct("last", "without").alias(SEEN))
        new = versions.unionByName(seen, allowMissingColumns=True).select(*self.stored_schema.fieldNames())
        buckets.replace(new, keys, self.n_buckets, self.history_path, batch_id + 1, lay, hit, sort_by=[*keys, "valid_from"])

    def _touched(self, this: DataFrame, seen: DataFrame) -> DataFrame:
        """A row a key of the batch: its bucket, ``_from`` (NULL: to be built anew), ``_last``,
        ``_without`` (a row had no sequence value) and ``_late``."""
        seq = F.col(self.sequence_by)
        own = this.filter(~F.coalesce(F.col(self.change_type) == PRE, F.lit(False))).groupBy(*self.keys, buckets.BUCKET).agg(
            F.min(seq).alias("_first"), F.max(seq).alias("_last"), F.max(seq.isNull()).alias("_without"))
        known = _null_safe(own, seen.select(*self.keys, F.col(SEEN).alias("_seen")), self.keys)
        anew = F.col("_without") | F.coalesce(F.col("_seen.without"), F.lit(False))
        late = F.col("_seen").isNotNull() & (anew | F.coalesce(F.col("_seen.last") >= F.col("_first"), F.lit(True)))
        return known.select(*self.keys, buckets.BUCKET, F.when(~anew, F.col("_first")).alias("_from"), "_last", "_without", late.alias("_late"))

    def _log_since(self, spark: SparkSession, batch_id: int, hit: Sequence[int], earliest) -> DataFrame:
        """The log of the given buckets up to a batch, from a sequence value on (None: all)."""
        schema = T.StructType([*self.change_schema.fields, T.StructField("batch_id", T.IntegerType()), T.StructField(buckets.BUCKET, T.IntegerType())])
        log = spark.read.schema(schema).parquet(self.log_path).filter((F.col("batch_id") <= batch_id) & F.col(buckets.BUCKET).isin(list(hit)))
        if earliest is not None:
            log = log.filter(F.col(self.sequence_by) >= F.lit(earliest).cast(self.change_schema[self.sequence_by].dataType))
        return log.drop("batch_id", buckets.BUCKET)


def run_available(
    spark: SparkSession,
    source_dir: str,
    fold: HistoryFold,
    checkpoint: str,
    evolve: bool = False,
) -> HistoryFold:
    """Process every file now in ``source_dir`` and stop (``availableNow``);
    call again after more files arrive -- the checkpoint resumes where the
    previous run stopped.  ``evolve`` takes on the columns and types that the files
    have beyond the fold's own; the fold that ran is returned."""
    if evolve:
        fold = fold.grown(spark, source_dir)
    stream = spark.readStream.schema(fold.change_schema).parquet(source_dir)
    q = (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return fold


def current_history(spark: SparkSession, fold: HistoryFold) -> DataFrame:
    """The whole history as the newest committed map has it."""
    stored = buckets.read(spark, fold.history_path, fold.stored_schema, buckets.layout(spark, fold.history_path))
    return stored.filter(F.col(SEEN).isNull()).drop(SEEN)
