"""The lattice of column types, and tables whose files have several."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.functions.widen import merged, wider
from rowgate.plans import jobs as J
from rowgate.sources import tables

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
MEETS = [
    (INT, LONG, LONG), (T.ByteType(), INT, INT), (INT, DOUBLE, DOUBLE), (T.FloatType(), DOUBLE, DOUBLE),
    (INT, T.DecimalType(8, 2), T.DecimalType(12, 2)), (LONG, T.DecimalType(8, 2), T.DecimalType(22, 2)),
    (T.DecimalType(10, 2), T.DecimalType(9, 4), T.DecimalType(12, 4)), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
]
NEVER = [(LONG, DOUBLE), (INT, T.StringType()), (T.DecimalType(38, 0), T.DecimalType(20, 10)), (T.DateType(), T.TimestampType())]


def test_the_lattice():
    for a, b, top in MEETS:
        assert wider(a, b) == wider(b, a) == top and wider(a, top) == wider(top, b) == top
    for a, b in NEVER:
        assert wider(a, b) is None and wider(b, a) is None
    x, y = T.StructType().add("a", INT).add("b", LONG), T.StructType().add("c", DOUBLE).add("a", LONG)
    assert merged([x, y]) == T.StructType().add("a", LONG).add("b", LONG).add("c", DOUBLE)
    with pytest.raises(ValueError, match="column a"):
        merged([x, T.StructType().add("a", T.StringType())])


def test_parts_of_every_narrower_type_read_as_the_wider_one(spark, run_root):
    """What the lattice promises holds for files: values come back unchanged."""
    for n, (a, b, top) in enumerate(MEETS):
        for t in (a, b):
            value = F.lit("2020-01-02") if isinstance(top, T.TimestampNTZType) else F.lit(7)
            tables.write(spark.range(3).select(value.cast(t).alias("x"), "id"), run_root, f"t{n}")
        got = tables.read_parts(spark, run_root, f"t{n}", T.StructType().add("id", LONG), evolve=True)
        assert got.schema["x"].dataType == top
        assert {str(r[0]) for r in got.select(F.col("x").cast("double" if not isinstance(top, T.TimestampNTZType) else "date")).collect()} in ({"7.0"}, {"2020-01-02"})
        assert got.count() == 6


def test_a_column_that_fits_no_type_stops_the_batch_before_anything_is_written(spark, run_root):
    st = J.State(spark, run_root)
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "id long, name string, age int")
    J.full_load_job(st, rows.withColumn("more", F.lit(5)), "2026-01-01 00:00:00", "parquet_full/20260101_000000")
    for bad in (rows.filter("age = 1"), rows.filter("age IS NULL")):  # against the clean table and the quarantine alike
        with pytest.raises(ValueError, match="column more"):
            J.partial_load_job(st, bad.withColumn("more", F.lit("text")), "2026-01-02 00:00:00", "parquet_partial/20260102_000000")
    assert st.pinned().at == 1
    J.partial_load_job(st, rows.filter("age = 1").withColumn("more", F.lit(5)), "2026-01-02 00:00:00", "parquet_partial/20260102_000000")
    J.partial_load_job(st, rows.filter("age = 1").withColumn("more", F.lit("1.25").cast("decimal(5,2)")), "2026-01-03 00:00:00", "parquet_partial/20260103_000000")
    assert [str(r.more) for r in st.read("clean").collect()] == ["1.25"]
    held = J.clean_history(st).orderBy("valid_from").collect()
    assert [(str(r.more), r.is_current) for r in held] == [("5.00", False), ("1.25", True)]


def test_a_pass_reads_only_the_feed_since_its_oldest_live_row(spark, run_root):
    import datetime as dt

    st = J.State(spark, run_root)
    for day in (1, 2, 3):
        rows = spark.createDataFrame([(day, "a", 1), (9, str(day), 1)], "id long, name string, age int")
        J.partial_load_job(st, rows, f"2026-01-0{day} 00:00:00", f"parquet_partial/2026010{day}_000000")
    come = spark.createDataFrame([(9, dt.datetime(2026, 1, 2)), (3, dt.datetime(2026, 1, 2)), (2, dt.datetime(2026, 1, 2))], "id long, ingestion_timestamp timestamp_ntz")
    for since in (None, dt.datetime(2026, 1, 2)):
        left = J._not_stale(st, come, since)
        assert [r.id for r in left.collect()] == [2]
    assert "_commit_timestamp" in left._jdf.queryExecution().toString().split("PushedFilters")[1]
