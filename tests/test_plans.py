"""Plan-shape guards: the scale properties the design relies on."""

from pyspark.sql import functions as F

from rowgate.operators.history import scd2
from rowgate.operators.keyed import anti, key_set, latest_per_key, upsert
from rowgate.operators.route import live_keys
from rowgate.plans.catalog import CONTRACT
from rowgate.plans.jobs import State
from rowgate.sources import bindings as B

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_upsert_streams_the_table(spark, run_root):
    st = State(spark, run_root, CONTRACT, B.PARAMS)
    st.write("clean", B.clean_0(spark, SF))
    target = st.read("clean")
    source = B.partial_route(spark, SF).extra["clean_rows"].limit(5)
    plan = _plan(upsert(target, source, ["id"]))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan


def test_state_reads_push_filters_and_prune_terminal(spark, run_root):
    st = State(spark, run_root, CONTRACT, B.PARAMS)
    st.write("quarantine", B.quarantine_1(spark, SF))
    plan = _plan(live_keys(st.read_live()))
    assert "PushedFilters: [In(quarantine_status" in plan
    assert "PartitionFilters: [isnotnull(terminal" in plan
    assert "ReadSchema: struct<id:bigint,quarantine_status:string>" in plan


def test_newest_per_key_aggregates_map_side(spark):
    df = B.changes(spark, SF)
    plan = _plan(latest_per_key(df, ["id"], ["seq", "tiebreak"]))
    assert "partial_max" in plan  # reduced before the shuffle: a hot key ships one row per map task
    assert "Window" not in plan


def test_split_history_windows_by_key_and_range(spark):
    import re

    plan = _plan(scd2(B.changes(spark, SF), ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"]))
    assert re.search(r"hashpartitioning\(id#\d+L?, _b#\d+, \d+\)", plan)
    assert "partial_min" in plan  # cut points are reduced before the shuffle


def test_history_without_hot_keys_is_a_count_and_a_window(spark):
    """Once the count has found no hot key, one shuffle for both windows is left; nothing by range."""
    df = scd2(B.changes(spark, SF), ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"])
    df.collect()
    ran = _plan(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in ran and "_b#" not in ran
    assert ran.count("Exchange hashpartitioning") == 1


def test_a_hot_key_is_cut_by_its_size(spark):
    rows = spark.range(4000).selectExpr("CAST(1 AS BIGINT) AS id", "id AS seq", "id % 2 AS v", "'insert' AS _change_type")
    df = scd2(rows, ["id"], "seq", ["v"], split_rows=100)
    marked = df.filter("valid_to IS NULL OR valid_to = valid_from + 1")
    assert marked.count() == 4000
    from rowgate.operators import history

    cut = history._ranged(rows.withColumns({"_n": F.lit(40).cast("long"), "_rk": F.lit(1), "_img": F.struct("v")}), ["id"], "seq", [], ["seq", "_rk"])
    plan = cut._jdf.queryExecution().analyzed().toString()
    assert "_b#" in plan and cut.count() == 4000


def test_compressible_keys_get_no_broadcast_hint(spark, tmp_path):
    """Catalyst's estimate of a key column counts compressed bytes; no hint rests on it."""
    spark.range(1_000_000).selectExpr("CAST(id % 10 AS STRING) AS id", "id AS v").write.parquet(f"{tmp_path}/t")
    big = spark.read.parquet(f"{tmp_path}/t")
    assert "hint" not in anti(big, key_set(big, ["id"]), ["id"])._jdf.queryExecution().analyzed().toString().lower()
