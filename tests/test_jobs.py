"""Jobs on stored state: pins, retries, ledgers, evolution and order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import FULL_AREA, PARTIAL_AREA
from rowgate.functions.timeexpr import plus_hours, ts
from rowgate.operators.history import scd2
from rowgate.plans import jobs as J
from rowgate.plans.catalog import CONTRACT
from rowgate.sources import bindings as B
from rowgate.sources import landing as S
from rowgate.sources import tables

SF = "/root/testdata/sf0.001"
AREAS = (FULL_AREA, PARTIAL_AREA)


def _all(st):
    return {n: sorted(map(str, st.read(n).collect())) for n in ("clean", "quarantine", "ledger", "dead_letter")}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, age int")


def test_quality_check_is_the_same_pinned_and_unpinned(spark, run_root):
    free, fixed = (J.State(spark, f"{run_root}/{n}", CONTRACT, B.PARAMS, at=a) for n, a in (("free", None), ("fixed", 0)))
    for st in (free, fixed):
        assert J.quality_check_job(st, B.landing(spark, SF), B.T2, areas=AREAS)["batches"]
    assert _all(free) == _all(fixed.after())
    assert _all(free)["clean"]


@pytest.mark.parametrize("stop_before", ["released", "quarantine", "clean", "clean_map", "changes", "ledger"])
def test_a_run_that_broke_off_is_run_again(spark, run_root, monkeypatch, stop_before):
    whole = J.State(spark, f"{run_root}/whole", CONTRACT, B.PARAMS)
    J.quality_check_job(whole, B.landing(spark, SF), B.T2, areas=AREAS)
    st, real = J.State(spark, f"{run_root}/broken", CONTRACT, B.PARAMS), tables.write

    def stops(df, root, name, *a, **k):
        if name == stop_before:
            raise RuntimeError("lost")
        return real(df, root, name, *a, **k)

    monkeypatch.setattr(tables, "write", stops)
    with pytest.raises(RuntimeError):
        J.quality_check_job(st, B.landing(spark, SF), B.T2, areas=AREAS)
    monkeypatch.setattr(tables, "write", real)
    J.quality_check_job(J.State(spark, f"{run_root}/broken", CONTRACT, B.PARAMS), B.landing(spark, SF), B.T2, areas=AREAS)
    assert _all(st) == _all(whole)


def test_idle_pass_writes_no_clean_version(spark, run_root):
    st = J.State(spark, run_root)
    J.full_load_job(st, _frame(spark, [(1, "a", 1), (2, "b", 2)]), "2026-01-01 00:00:00", "parquet_full/20260101_000000")
    before = tables.versions(spark, run_root, "clean")
    J.maintenance_job(st, "2026-01-01 01:00:00")
    assert tables.versions(spark, run_root, "clean") == before
    assert st.read("clean").count() == 2


def test_a_merge_writes_only_the_buckets_of_its_keys(spark, run_root):
    st = J.State(spark, run_root, rows_per_bucket=10)
    rows = [(i, "a", i) for i in range(100)]
    J.full_load_job(st, _frame(spark, rows), "2026-01-01 00:00:00", "parquet_full/20260101_000000")
    whole = st._layout()
    assert whole.buckets == 10 and whole.rows == 100
    J.partial_load_job(st, _frame(spark, [(7, "b", 1)]), "2026-01-01 01:00:00", "parquet_partial/20260101_010000")
    after = st._layout()
    assert len([b for b, x in after.held.items() if whole.held[b] != x]) == 1
    assert sorted(map(tuple, st.read("clean").collect())) == sorted([*rows[:7], *rows[8:], (7, "b", 1)])
    more = [(i, "c", 0) for i in range(100, 350)]  # outgrows the buckets: the next merge deals the table out anew
    J.partial_load_job(st, _frame(spark, more), "2026-01-01 02:00:00", "parquet_partial/20260101_020000")
    J.partial_load_job(st, _frame(spark, [(7, "d", 2)]), "2026-01-01 03:00:00", "parquet_partial/20260101_030000")
    assert st._layout().buckets == 35 and st._layout().rows == 350
    assert sorted(map(tuple, st.read("clean").collect())) == sorted([*rows[:7], *rows[8:], *more, (7, "d", 2)])


def test_release_does_not_overwrite_a_newer_clean_row(spark, run_root):
    st = J.State(spark, run_root)
    J.full_load_job(st, _frame(spark, [(2, "b", None)]), "2026-01-01 01:00:00", "parquet_full/20260101_010000")
    J.partial_load_job(st, _frame(spark, [(2, "b", 20)]), "2026-01-01 02:00:00", "parquet_partial/20260101_020000")
    J.full_load_job(st, _frame(spark, [(2, "b", 99)]), "2026-01-01 03:00:00", "parquet_full/20260101_030000")
    J.maintenance_job(st, "2026-01-01 04:00:00", order=("release",))
    assert [tuple(r) for r in st.read("clean").collect()] == [(2, "b", 99)]
    assert st.read("quarantine").filter("quarantine_status <> 'RELEASED'").count() == 0


def test_full_load_keeps_one_row_a_key(spark, run_root):
    st = J.State(spark, run_root)
    for n, t in enumerate(("00", "01")):
        J.full_load_job(st, _frame(spark, [(1, "a", a + n) for a in range(20)]), f"2026-01-01 {t}:00:00", f"parquet_full/20260101_{t}0000")
    assert st.read("clean").count() == 1 and st.read("changes").count() == 3
    assert J.full_load_job(st, _frame(spark, []), "2026-01-02 00:00:00", "parquet_full/20260101_010000") == {"skipped": True}


def test_wide_files_and_values_that_do_not_cast(spark, run_root):
    st = J.State(spark, run_root)
    rows = spark.createDataFrame([(1, "a", 1 << 40), (2, "b", 7), (3, "c", None)], "id long, name string, age long")
    J.full_load_job(st, rows, "2026-01-01 00:00:00", "parquet_full/20260101_000000")
    got = {r.id: (r.age, r.validation_errors) for r in st.read("quarantine").collect()}
    assert got == {1: (None, ["bad_type_age"]), 3: (None, ["null_age"])}
    assert [r.id for r in st.read("clean").collect()] == [2]


def test_files_of_other_types_load_from_folders(spark, run_root):
    land = f"{run_root}/landing"
    B.landing_full(spark, SF).withColumn("age", F.col("age").cast("long")).write.parquet(f"{land}/{B.SOURCE_F}")
    st = J.State(spark, f"{run_root}/state", CONTRACT, B.PARAMS)
    assert J.quality_check_from_root(st, land, (FULL_AREA,), B.T1)["batches"] == [(FULL_AREA, B.BATCH_F)]
    assert st.read("clean").count() > 0


def test_versions_beyond_six_digits_and_folders_of_crashed_writes(spark, run_root):
    schema = T.StructType([T.StructField("x", T.LongType())])
    for v in (999_999, 1_000_000):
        tables.write(spark.range(v, v + 1).toDF("x"), run_root, "t", version=v)
    assert tables.read(spark, run_root, "t", schema).first().x == 1_000_000
    spark.range(3).toDF("x").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{run_root}/t/v=1000001")
    assert tables.versions(spark, run_root, "t")[-1] == 1_000_000
    assert tables.write(spark.range(5, 6).toDF("x"), run_root, "t") == 1_000_001
    assert tables.read(spark, run_root, "t", schema).first().x == 5


def test_nested_folders_belong_to_their_batch(spark, run_root):
    _frame(spark, [(1, "a", 1)]).write.parquet(f"{run_root}/parquet_full/20260101_000000/region=eu")
    got = S.read_landing(spark, run_root).select("id", "area", "batch").collect()
    assert [tuple(r) for r in got] == [(1, "parquet_full", "20260101_000000")]


def test_half_an_hour(spark):
    t = spark.range(1).select(plus_hours(ts("2026-01-01 00:00:00"), 0.5).alias("t")).first().t
    assert t == dt.datetime(2026, 1, 1, 0, 30)


@pytest.mark.parametrize("split_rows", [0, 5, 10**9])
def test_history_with_text_sequences_and_null_keys(spark, split_rows):
    rows = [(k, f"s{n:03d}", n % 4, "update_postimage") for k in (None, 1, 2) for n in range(40)]
    df = spark.createDataFrame(rows, "id long, seq string, v int, _change_type string")
    got = scd2(df, ["id"], "seq", ["v"], split_rows=split_rows, split_ranges=8)
    want = {(k, f"s{n:03d}", f"s{n + 1:03d}" if n < 39 else None) for k in (None, 1, 2) for n in range(40)}
    assert {(r.id, r.valid_from, r.valid_to) for r in got.collect()} == want and got.count() == 120


def test_a_late_file_is_loaded_and_nothing_twice(spark, run_root):
    land = f"{run_root}/landing"
    st = J.State(spark, f"{run_root}/state")
    folder = f"{land}/{PARTIAL_AREA}/20260101_000000"

    def lands(rows):
        _frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        return J.load_folder_job(st, land, PARTIAL_AREA, "2026-01-01 00:00:00", full=False)

    lands([(1, "a", 1), (2, "b", None)])
    assert lands([(3, "c", 3), (2, "b", 5), (4, None, 4)])["total_processed"] == 3
    assert J.load_folder_job(st, land, PARTIAL_AREA, "2026-01-01 00:00:00", full=False) == {"skipped": True}
    assert J.quality_check_from_root(st, land, (PARTIAL_AREA,), "2026-01-01 01:00:00") == {"batches": []}
    assert sorted(r.id for r in st.read("clean").collect()) == [1, 3]
    assert sorted(r.id for r in st.read("quarantine").collect()) == [2, 2, 4]
    assert st.read("ledger").count() == 2
    with pytest.raises(FileNotFoundError):
        J.load_folder_job(st, land, FULL_AREA, "2026-01-01 00:00:00", full=True)


def test_a_batch_loaded_as_a_whole_is_known_by_its_files(spark, run_root):
    land = f"{run_root}/landing"
    st = J.State(spark, f"{run_root}/state")
    _frame(spark, [(1, "a", 1)]).write.parquet(f"{land}/{FULL_AREA}/20260101_000000")
    J.full_load_job(st, spark.read.parquet(f"{land}/{FULL_AREA}/20260101_000000"), "2026-01-01 00:00:00", f"{FULL_AREA}/20260101_000000")
    assert J.load_folder_job(st, land, FULL_AREA, "2026-01-01 01:00:00", full=True) == {"skipped": True}


def test_files_of_one_folder_with_different_types(spark, run_root):
    land = f"{run_root}/landing"
    folder = f"{land}/{FULL_AREA}/20260101_000000"
    _frame(spark, [(1, "a", 1)]).write.parquet(folder)
    spark.createDataFrame([(2, "b", 1 << 40, "x"), (3, "c", 9, "y")], "id long, name string, age long, more string").write.mode("append").parquet(folder)
    st = J.State(spark, f"{run_root}/state")
    J.load_folder_job(st, land, FULL_AREA, "2026-01-01 00:00:00", full=True)
    assert sorted(tuple(r) for r in st.read("clean").select("id", "age", "more").collect()) == [(1, 1, None), (3, 9, "y")]
    assert [(r.id, r.validation_errors) for r in st.read("quarantine").collect()] == [(2, ["bad_type_age"])]


def test_overlapping_runs_lose_nothing(spark, run_root, monkeypatch):
    """A run that starts inside another is refused; one that pinned before the other
    ended goes on from the newer version."""
    from rowgate.sources.claims import RunInProgress

    st = J.State(spark, run_root)
    load = lambda i: J.partial_load_job(J.State(spark, run_root), _frame(spark, [(i, "a", 1)]), "2026-01-01 00:00:00", f"p/20260101_00000{i}")
    load(0)
    real, refused = tables.write, []

    def inside(df, root, name, *a, **k):
        if name == "quarantine" and not refused:
            refused.append(1)
            with pytest.raises(RunInProgress):
                load(1)
            with pytest.raises(RunInProgress):
                J.maintenance_job(J.State(spark, run_root), "2026-01-01 00:00:00")
        return real(df, root, name, *a, **k)

    monkeypatch.setattr(tables, "write", inside)
    load(2)
    monkeypatch.undo()
    load(1)
    pin = J.State.pinned

    def late(self):
        got = pin(self)
        if self.at is None and len(refused) < 2:
            refused.append(2)
            load(3)
        return got

    monkeypatch.setattr(J.State, "pinned", late)
    load(4)
    monkeypatch.undo()
    assert sorted(r.id for r in st.read("clean").collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.batch for r in st.read("ledger").collect()) == [f"20260101_00000{i}" for i in range(5)]


def test_a_lost_runs_claim_is_taken_over_when_stale(spark, run_root):
    from rowgate.sources.claims import Claim, RunInProgress

    first = Claim(spark, run_root, 7, 3600)
    with pytest.raises(RunInProgress):
        Claim(spark, run_root, 7, 3600)
    second = Claim(spark, run_root, 7, -1)
    with pytest.raises(RunInProgress):
        first.check()
    first.release()
    second.check()
    second.release()
    Claim(spark, run_root, 7, 3600).release()


def test_a_full_load_writes_only_the_buckets_that_changed(spark, run_root):
    st = J.State(spark, run_root, rows_per_bucket=10)
    rows = [(i, "a", i) for i in range(100)]
    load = lambda rows, h: J.full_load_job(st, _frame(spark, rows).repartition(3), f"2026-01-0{h} 00:00:00", f"parquet_full/2026010{h}_000000")
    load(rows, 1)
    whole = st._layout()
    out = load([*rows[:7], (7, "b", 7), *rows[8:]], 2)
    after = st._layout()
    assert out["change_rows"] == 2 and len([b for b, x in after.held.items() if whole.held[b] != x]) == 1
    assert load([*rows[:7], (7, "b", 7), *rows[8:]], 3)["change_rows"] == 0 and st._layout() == after
    out = load([*rows[:50], (7, "b", 7)][8:], 4)  # deletes, in some buckets; one key back to its first row is an update
    assert st._layout().rows == len({r[0] for r in [*rows[8:50], (7, "b", 7)]}) and out["change_rows"] == 57
    J.partial_load_job(st, _frame(spark, [(7, "c", 1)]), "2026-01-05 00:00:00", "parquet_partial/20260105_000000")
    out = load([*rows[8:50], (7, "c", 1)], 6)
    assert out["change_rows"] == 0
    out = load([*rows[8:50], (7, None, 1)], 7)
    assert out["change_rows"] == 1 and sorted(map(tuple, st.read("clean").collect())) == rows[8:50]
    load([], 8)
    assert st.read("clean").count() == 0
    changes = scd2(st.read("changes"), ["id"], "_commit_version", ["name", "age"]).where("valid_to IS NULL")
    assert changes.count() == 0


def test_digests_tell_nulls_and_columns_apart(spark):
    from rowgate.sources import buckets

    def of(rows):
        return tuple(spark.createDataFrame(rows, "id long, a string, b string").agg(*buckets._digest(["id", "a", "b"])).first())

    assert of([(1, "x", None), (2, "y", "z")]) == of([(2, "y", "z"), (1, "x", None)])
    assert len({of([(1, "x", None)]), of([(1, None, "x")]), of([(1, "x", "x")]), of([(1, None, None)]), of([(1, "", None)])}) == 5


def test_a_replay_undoes_the_first_try_only(spark, run_root):
    """Keys that a later load changed keep its row, also further columns come back, and
    the feed's history ends in the clean table."""
    st = J.State(spark, run_root)
    first, again, later = (f"parquet_partial/2026010{n}_000000" for n in (2, 2, 3))
    wide = _frame(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4)]).withColumn("segment", F.col("id") * 10)
    J.full_load_job(st, wide, "2026-01-01 00:00:00", "parquet_full/20260101_000000")
    J.partial_load_job(st, _frame(spark, [(1, "x", 1), (2, "x", 2), (4, "x", None), (5, "x", 5), (6, "x", 6)]), "2026-01-02 00:00:00", first)
    J.partial_load_job(st, _frame(spark, [(2, "later", 2), (6, "later", 6), (7, None, 7)]), "2026-01-03 00:00:00", later)
    J.replay_job(st, _frame(spark, [(3, "r", 3), (4, "r", 4), (8, None, 8)]), "2026-01-04 00:00:00", again)
    clean = {r.id: (r.name, r.segment) for r in st.read("clean").collect()}
    assert clean == {1: ("a", 10), 2: ("later", None), 3: ("r", None), 4: ("r", None), 6: ("later", None)}
    assert sorted((r.id, r.source_file) for r in st.read("quarantine").collect()) == [(7, later), (8, again)]
    J.replay_job(st, _frame(spark, [(5, "s", 5)]), "2026-01-05 00:00:00", again)  # a second one undoes the first replay too
    clean = {r.id: (r.name, r.segment) for r in st.read("clean").collect()}
    assert clean == {1: ("a", 10), 2: ("later", None), 3: ("c", 30), 4: ("d", 40), 5: ("s", None), 6: ("later", None)}
    assert [r.id for r in st.read("quarantine").collect()] == [7]
    held = {r.id: r.name for r in J.clean_history(st).filter("is_current").collect()}
    assert held == {k: v[0] for k, v in clean.items()}
    assert J.partial_load_job(st, wide, "2026-01-06 00:00:00", again) == {"skipped": True}


def test_a_replay_refuses_what_it_cannot_tell_apart(spark, run_root):
    st = J.State(spark, run_root)
    with pytest.raises(ValueError, match="has not been loaded"):
        J.replay_job(st, _frame(spark, []), "2026-01-01 00:00:00", "parquet_partial/20260101_000000")
    J.quality_check_job(st, B.landing(spark, SF), B.T2, areas=AREAS)
    with pytest.raises(ValueError, match="more than route"):
        J.replay_job(st, B.landing_partial(spark, SF), B.T2, B.SOURCE_P)
