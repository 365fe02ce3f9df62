"""SURVEY §5 invariants over the sf0.001 bindings."""

import pytest
from pyspark.sql import functions as F

from rowgate.operators import lifecycle as L
from rowgate.operators.history import scd2
from rowgate.operators.route import route
from rowgate.plans.catalog import CONTRACT
from rowgate.plans.jobs import State, maintenance_job
from rowgate.sources import bindings as B

SF = "/root/testdata/sf0.001"


def test_every_row_lands_once(spark):
    incoming = B.landing_partial(spark, SF)
    r = route(incoming, B.quarantine_0(spark, SF), B.PARAMS, B.T1, B.SOURCE_P)
    n_in, n_clean, n_bad = incoming.count(), r.clean.count(), r.quarantine.count()
    assert n_in == n_clean + n_bad
    # same rows, as multisets
    both = r.clean.select("id", "name", "age").unionByName(r.quarantine.select("id", "name", "age"))
    assert both.exceptAll(incoming).count() == 0 and incoming.exceptAll(both).count() == 0


def test_clean_has_no_nulls_and_unique_keys(spark):
    c = B.clean_1(spark, SF)
    assert c.filter(F.col("id").isNull() | F.col("name").isNull() | F.col("age").isNull()).count() == 0
    assert c.groupBy("id").count().filter("count > 1").count() == 0


def test_history_one_open_row_no_overlap(spark):
    h = scd2(B.changes(spark, SF), ["id"], "seq", ["event_type", "value"], change_type="change_type", tiebreak=["tiebreak"])
    assert h.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy("valid_from")
    overl = h.withColumn("nxt", F.lead("valid_from").over(w)).filter(F.col("valid_to").isNull() & F.col("nxt").isNotNull()
                                                                      | (F.col("valid_to") > F.col("nxt")))
    assert overl.count() == 0


def test_dead_letter_equals_expired(spark):
    q1 = B.quarantine_1(spark, SF)
    q2, dead, moved = L.expire(q1, None, B.T2, B.PARAMS)
    assert dead.count() == q2.filter(F.col("quarantine_status") == "EXPIRED").count() == 48


def test_pass_twice_changes_nothing(spark, run_root):
    st = State(spark, run_root, CONTRACT, B.PARAMS)
    st.write("clean", B.clean_1(spark, SF))
    st.write("quarantine", B.quarantine_1(spark, SF))
    first = maintenance_job(st, B.T2)
    clean1 = st.read("clean").collect()
    q1 = st.read("quarantine").collect()
    second = maintenance_job(st, B.T2)
    assert sorted(map(tuple, st.read("clean").collect())) == sorted(map(tuple, clean1))
    assert sorted(map(str, st.read("quarantine").collect())) == sorted(map(str, q1))
    assert second["expired_rows"] == 0 and second["released_keys"] == 0 and second["promoted_keys"] == 0
    # FIXTURES §5 counts at sf0.001: 48 expired, 9 released, 118 clean
    assert (first["expired_rows"], first["released_keys"], first["clean_rows"]) == (48, 9, 118)


@pytest.mark.parametrize("name,rows", [("landing_full", 150), ("landing_partial", 53), ("landing_full_2", 133)])
def test_binding_sizes(spark, name, rows):
    assert getattr(B, name)(spark, SF).count() == rows


def test_rerun_of_pinned_job_is_idempotent(spark, run_root):
    # a maintenance run that is repeated with the same pin (as after a crash
    # between its writes) leaves exactly the same state
    from rowgate.plans.jobs import summary_frame

    st = State(spark, run_root, CONTRACT, B.PARAMS)
    st.write("clean", B.clean_1(spark, SF))
    st.write("quarantine", B.quarantine_1(spark, SF))
    run1 = State(spark, run_root, CONTRACT, B.PARAMS, at=1)
    m1 = maintenance_job(run1, B.T2)
    s1 = summary_frame(run1, B.T2).first()
    after1 = sorted(map(str, run1.after().read("quarantine").collect()))
    run2 = State(spark, run_root, CONTRACT, B.PARAMS, at=1)
    m2 = maintenance_job(run2, B.T2)
    assert m1 == m2
    assert summary_frame(run2, B.T2).first() == s1
    assert sorted(map(str, run2.after().read("quarantine").collect())) == after1
    assert (s1.expired_rows, s1.released_keys, s1.clean_rows) == (48, 9, 118)


def test_quality_check_job_skips_processed_batches(spark, run_root):
    from rowgate.contracts import FULL_AREA, PARTIAL_AREA
    from rowgate.plans.jobs import quality_check_job

    st = State(spark, run_root, CONTRACT, B.PARAMS)
    landing = B.landing(spark, SF)
    first = quality_check_job(st, landing, B.T2, areas=(FULL_AREA, PARTIAL_AREA))
    assert first["batches"] == [(FULL_AREA, B.BATCH_F2), (PARTIAL_AREA, B.BATCH_P)]
    q1 = sorted(map(str, st.read("quarantine").collect()))
    c1 = sorted(map(tuple, st.read("clean").collect()))
    again = quality_check_job(st, landing, B.T2, areas=(FULL_AREA, PARTIAL_AREA))
    assert again["batches"] == []
    assert sorted(map(str, st.read("quarantine").collect())) == q1
    assert sorted(map(tuple, st.read("clean").collect())) == c1
    c = st.read("clean")
    assert c.groupBy("id").count().filter("count > 1").count() == 0
    assert c.filter(F.col("name").isNull() | F.col("age").isNull()).count() == 0
    assert st.read("ledger").count() == 2


def test_quality_check_from_folders(spark, run_root):
    from rowgate.contracts import FULL_AREA, PARTIAL_AREA
    from rowgate.plans.jobs import quality_check_from_root

    land = f"{run_root}/landing"
    for df_, src in ((B.landing_full(spark, SF), B.SOURCE_F), (B.landing_partial(spark, SF), B.SOURCE_P),
                     (B.landing_full_2(spark, SF), B.SOURCE_F2)):
        df_.write.parquet(f"{land}/{src}")
    st = State(spark, f"{run_root}/state", CONTRACT, B.PARAMS)
    out = quality_check_from_root(st, land, (FULL_AREA, PARTIAL_AREA), B.T2)
    assert out["batches"] == [(FULL_AREA, B.BATCH_F2), (PARTIAL_AREA, B.BATCH_P)]
    assert quality_check_from_root(st, land, (FULL_AREA, PARTIAL_AREA), B.T2)["batches"] == []
