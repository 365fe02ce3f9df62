"""Edge rows of FIXTURES.md §3 and the rulings of SURVEY §7.4."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import Params
from rowgate.operators import lifecycle as L
from rowgate.operators.history import scd2, snapshot_changes
from rowgate.operators.keyed import latest_per_key, upsert
from rowgate.operators.route import route, validate
from rowgate.sources import landing as S

DATA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                     T.StructField("age", T.IntegerType())])
P = Params()


def df(spark, rows):
    return spark.createDataFrame(rows, DATA)


def quarantine_of(spark, rows, as_of="2026-01-01 00:00:00"):
    return route(df(spark, rows), None, P, as_of, "a/b", stack=False).quarantine


def test_null_key_in_live_set_keeps_clean_rows(spark):
    # R-2: a live row with a NULL key must not make every incoming row vanish
    q = quarantine_of(spark, [(5, None, 1), (None, "x", 2)])
    r = route(df(spark, [(1, "a", 1), (2, "b", 2), (5, "c", 3), (None, "d", 4)]), q, P, "2026-01-01 01:00:00")
    assert sorted(x.id for x in r.clean.collect()) == [1, 2]
    bad = {(x.id, x.quarantine_status) for x in r.quarantine.collect()}
    assert bad == {(5, "BLOCKED"), (None, "QUARANTINE")}


def test_null_key_always_fails_even_if_not_required(spark):
    # R-3
    r = route(df(spark, [(None, "a", 1)]), None, Params(required=("name",)), "2026-01-01 00:00:00", stack=False)
    assert r.clean.count() == 0
    assert r.quarantine.first().quarantine_reason == "null_id"


def test_several_errors_in_one_row(spark):
    v = validate(df(spark, [(1, None, None)]), P).first()
    assert v.validation_errors == ["null_name", "null_age"]
    q = quarantine_of(spark, [(1, None, None)]).first()
    assert q.quarantine_reason == "null_name, null_age"


def test_two_rows_of_one_key_in_a_batch_upsert_keeps_one(spark):
    target = df(spark, [(1, "old", 10)])
    out = upsert(target, df(spark, [(1, "a", 20), (1, "b", 30), (2, "c", 1)]), ["id"]).collect()
    assert len(out) == 2 and {r.id for r in out} == {1, 2}


def test_good_row_then_worse_row_release_picks_valid(spark):
    # R-5: newest *valid* row is released, not a newer row with nulls
    first = quarantine_of(spark, [(1, None, 19)], "2026-01-01 00:00:00")
    good = route(df(spark, [(1, "good", 20)]), first, P, "2026-01-01 01:00:00").quarantine  # BLOCKED
    worse = quarantine_of(spark, [(1, None, 21)], "2026-01-01 02:00:00")
    clean, q2, released = L.release_fixed(df(spark, []), first.unionByName(good).unionByName(worse), P)
    assert [(r.id, r.name, r.age) for r in released.collect()] == [(1, "good", 20)]
    assert {r.quarantine_status for r in q2.collect()} == {"RELEASED"}


def test_empty_batch(spark):
    r = route(df(spark, []), None, P, "2026-01-01 00:00:00")
    assert r.clean.count() == 0 and r.quarantine.count() == 0
    assert r.summary.first().total_processed == 0


def test_area_with_no_batch_and_bad_folder_names(spark, run_root):
    land = f"{run_root}/landing"
    df(spark, [(1, "a", 1)]).write.parquet(f"{land}/parquet_full/20260101_000000")
    df(spark, [(2, "b", 2)]).write.parquet(f"{land}/parquet_full/20260102_000000")
    df(spark, [(3, "c", 3)]).write.parquet(f"{land}/parquet_full/_tmp_not_a_batch")
    df(spark, [(4, "d", 4)]).write.parquet(f"{land}/parquet_partial/20250101_000000")
    rows = S.read_landing(spark, land)
    assert sorted(r.id for r in S.latest_batch(rows, "parquet_full").collect()) == [2]
    assert sorted(r.id for r in S.latest_per_area(rows).collect()) == [2, 4]
    assert S.latest_batch(rows, "no_such_area").count() == 0


def test_unchanged_row_resent_makes_no_change(spark):
    a = df(spark, [(1, "a", 1), (2, "b", 2)])
    ch = snapshot_changes(a, df(spark, [(1, "a", 1), (2, "b", 2)]), ["id"], 2, "2026-01-02 00:00:00")
    assert ch.count() == 0


def test_delete_then_reinsert_reopens_key(spark):
    v1 = df(spark, [(1, "a", 1)])
    v2 = df(spark, [])
    v3 = df(spark, [(1, "a", 1)])
    feed = (snapshot_changes(v2, v1, ["id"], 1, "2026-01-01 00:00:00")
            .unionByName(snapshot_changes(v1, v2, ["id"], 2, "2026-01-02 00:00:00"))
            .unionByName(snapshot_changes(v2, v3, ["id"], 3, "2026-01-03 00:00:00")))
    h = sorted((r.valid_from, r.valid_to) for r in scd2(feed, ["id"], "_commit_version", ["name", "age"]).collect()
               if True)
    assert h == [(1, 2), (3, None)] or [(r[0], r[1]) for r in h] == [(1, 2), (3, None)]


def test_upsert_beats_delete_at_same_sequence(spark):
    # R-9: an overwrite emits delete + insert at one sequence; the upsert wins
    rows = spark.createDataFrame(
        [(1, "x", 1, "insert", 1), (1, "x", 1, "delete", 2), (1, "y", 1, "insert", 2)],
        "id long, name string, age int, _change_type string, _commit_version long")
    h = scd2(rows, ["id"], "_commit_version", ["name"]).collect()
    assert sorted((r.name, r.valid_from, r.valid_to) for r in h) == [("x", 1, 2), ("y", 2, None)]


def test_hot_key_latest_per_key(spark):
    # a third of all rows on one key: still one row per key, the newest
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("ts"))
    out = latest_per_key(hot, ["k"], ["ts"])
    assert out.count() == 20000  # 20000 other ids, one of them (7) merges with the hot key
    assert out.filter("k = 7").first().ts == 29997


def test_history_split_plan_equals_plain_with_hot_key(spark):
    # Move a third of all change rows onto one key (rows kept whole) and
    # check the skew-safe plan against the per-key window plan.
    from rowgate.sources import bindings as B

    ch = B.changes(spark, "/root/testdata/sf0.001")
    hot = ch.withColumn("id", F.when(F.col("tiebreak") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
    for df in (ch, hot):
        kw = dict(change_type="change_type", tiebreak=["tiebreak"])
        plain = scd2(df, ["id"], "seq", ["event_type", "value"], split_rows=10**9, **kw)
        split = scd2(df, ["id"], "seq", ["event_type", "value"], split_rows=20, split_ranges=8, **kw)
        assert plain.count() == split.count()
        assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_missing_batch_raises_and_readability_probe(spark, run_root):
    import pytest

    land = f"{run_root}/landing"
    df(spark, [(1, "a", 1)]).write.parquet(f"{land}/parquet_full/20260101_000000")
    rows = S.read_landing(spark, land)
    assert S.require_latest_batch(rows, "parquet_full") == "20260101_000000"
    with pytest.raises(FileNotFoundError):
        S.require_latest_batch(rows, "parquet_partial")
    assert S.is_readable(spark, f"{land}/parquet_full/20260101_000000", DATA)
    assert not S.is_readable(spark, f"{land}/nothing_here")


def test_create_all_is_idempotent(spark, run_root):
    from rowgate.plans.jobs import State, create_all

    st = State(spark, run_root, DATA)
    assert create_all(st) == ["clean", "quarantine", "dead_letter", "history"]
    assert create_all(st) == []
    assert st.read("clean").count() == 0 and st.read("quarantine").count() == 0


def test_jobs_pin_types_and_reject_missing_columns(spark, run_root):
    import pytest

    from rowgate.plans.jobs import State, full_load_job

    st = State(spark, run_root, DATA)
    wide = spark.createDataFrame([(1, "a", 30)], "id long, name string, age long")
    full_load_job(st, wide, "2026-01-01 00:00:00", "parquet_full/20260101_000000")
    assert dict(st.read("clean").dtypes)["age"] == "int"
    with pytest.raises(ValueError):
        full_load_job(st, spark.createDataFrame([(1, "a")], "id long, name string"), "2026-01-01 01:00:00", "x/y")


def test_newest_batch_from_folder_listing(spark, run_root):
    import pytest

    land = f"{run_root}/landing"
    df(spark, [(1, "a", 1)]).write.parquet(f"{land}/parquet_full/20260101_000000")
    df(spark, [(2, "b", 2)]).write.parquet(f"{land}/parquet_full/20260102_000000")
    df(spark, [(3, "c", 3)]).write.parquet(f"{land}/parquet_full/_tmp_not_a_batch")
    assert S.list_batches(spark, land, "parquet_full") == ["20260101_000000", "20260102_000000"]
    rows = S.read_newest(spark, land, "parquet_full", DATA).collect()
    assert [(r.id, r.batch) for r in rows] == [(2, "20260102_000000")]
    with pytest.raises(FileNotFoundError):
        S.read_newest(spark, land, "parquet_partial")


def test_clean_sink_modes(spark):
    import pytest

    from rowgate.operators.route import clean_sink

    old, new = df(spark, [(1, "a", 1), (2, "b", 2)]), df(spark, [(2, "c", 3), (3, "d", 4)])
    got = {m: sorted(tuple(r) for r in clean_sink(old, new, m).collect()) for m in ("overwrite", "append", "merge")}
    assert got["overwrite"] == [(2, "c", 3), (3, "d", 4)]
    assert got["append"] == [(1, "a", 1), (2, "b", 2), (2, "c", 3), (3, "d", 4)]
    assert got["merge"] == [(1, "a", 1), (2, "c", 3), (3, "d", 4)]
    assert clean_sink(None, new, "append").count() == clean_sink(None, new, "merge").count() == 2
    with pytest.raises(ValueError):
        clean_sink(old, new, "upsert")
