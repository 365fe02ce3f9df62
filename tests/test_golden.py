"""
run through the jobs layer over versioned state."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import clean_schema
from rowgate.operators.history import scd2, snapshot_changes
from rowgate.plans.jobs import State, clean_history, full_load_job, maintenance_job, partial_load_job
from rowgate.sources import tables

# G1 batches (id, name, age); None is NULL.  Ids, ages and nulls are fixed values of the trace; the names are invented.
FULL_1 = [(1, "Nuri", 30), (2, "Odile", None), (3, "Pim", 25), (4, "Quirin", None), (5, "Ravi", 28)]
PARTIAL_1 = [(1, "Nuri", 31), (2, "Odile", 35), (6, "Sunna", None), (7, "Tove", 27)]
FULL_2 = [(1, "Nuri", 32), (3, "Pim", 26), (5, "Ravi", 29), (8, "Umar", None), (9, "Vesna", 24)]
PARTIAL_2 = [(1, "Nuri", 33), (8, "Umar", 40), (10, "Wim", None), (11, "Xenia", 26)]

# Landing schema of the reference fixtures: BIGINT id/age; pinned to the contract at the edge.
LANDING = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("age", T.LongType(), True),
])


def _df(spark, rows):
    # BIGINT age as in the fixture generators; the jobs cast it to the contract's INT at the edge
    return spark.createDataFrame(rows, LANDING)


def _clean(st):
    return {r.id: r.age for r in st.read("clean").collect()}


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def _quarantine(st):
    return sorted(((r.id, r.age, r.quarantine_status, r.fix_attempts) for r in st.read("quarantine").collect()), key=_key)


def test_golden_four_batches(spark, run_root):
    st = State(spark, run_root)
    full_load_job(st, _df(spark, FULL_1), "2026-03-06 01:00:00", "parquet_full/20260306_010000")
    assert _clean(st) == {1: 30, 3: 25, 5: 28}
    assert _quarantine(st) == sorted([(2, None, "QUARANTINE", 0), (4, None, "QUARANTINE", 0)], key=_key)

    partial_load_job(st, _df(spark, PARTIAL_1), "2026-03-06 06:00:00", "parquet_partial/20260306_060000")
    assert _clean(st) == {1: 31, 3: 25, 5: 28, 7: 27}
    assert (6, None, "QUARANTINE", 0) in _quarantine(st) and (2, 35, "BLOCKED", 0) in _quarantine(st)

    maintenance_job(st, "2026-03-06 07:00:00")
    assert _clean(st) == {1: 31, 2: 35, 3: 25, 5: 28, 7: 27}
    assert [q for q in _quarantine(st) if q[0] == 2] == sorted([(2, None, "RELEASED", 1), (2, 35, "RELEASED", 1)], key=_key)

    full_load_job(st, _df(spark, FULL_2), "2026-03-06 08:00:00", "parquet_full/20260306_080000")
    assert _clean(st) == {1: 32, 3: 26, 5: 29, 9: 24}

    partial_load_job(st, _df(spark, PARTIAL_2), "2026-03-06 12:00:00", "parquet_partial/20260306_120000")
    assert _clean(st) == {1: 33, 3: 26, 5: 29, 9: 24, 11: 26}

    maintenance_job(st, "2026-03-06 13:00:00")
    assert _clean(st) == {1: 33, 3: 26, 5: 29, 8: 40, 9: 24, 11: 26}
    q = _quarantine(st)
    assert sorted(r[0] for r in q if r[2] == "RELEASED") == [2, 2, 8, 8]
    assert sorted(r[0] for r in q if r[2] == "QUARANTINE") == [4, 6, 10]
    assert not [r for r in q if r[2] not in ("RELEASED", "QUARANTINE")]

    # History from the six clean versions: 13 rows, 6 open -- once from the
    # change feed the jobs published (touched keys only), once by diffing
    # whole snapshots; both must agree.
    vs = tables.versions(spark, run_root, "clean")
    assert len(vs) == 6
    hist = clean_history(st).collect()
    schema = clean_schema()
    frames = [tables.read(spark, run_root, "clean", schema, version=v) for v in vs]
    feed = None
    prev = frames[0].filter(F.lit(False))
    for v, cur in zip(vs, frames):
        ch = snapshot_changes(prev, cur, ["id"], v, f"2026-03-06 0{v}:00:00")
        feed = ch if feed is None else feed.unionByName(ch)
        prev = cur
    diffed = scd2(feed, ["id"], "_commit_version", ["name", "age"]).collect()
    assert sorted(map(tuple, diffed), key=_key) == sorted(map(tuple, hist), key=_key)
    assert len(hist) == 13
    assert sum(1 for h in hist if h.is_current) == 6
    got = sorted(((h.id, h.age, h.valid_from, h.valid_to) for h in hist), key=_key)
    assert got == sorted([
        (1, 30, 1, 2), (1, 31, 2, 4), (1, 32, 4, 5), (1, 33, 5, None), (2, 35, 3, 4),
        (3, 25, 1, 4), (3, 26, 4, None), (5, 28, 1, 4), (5, 29, 4, None), (7, 27, 2, 4),
        (8, 40, 6, None), (9, 24, 4, None), (11, 26, 5, None),
    ], key=_key)


def test_golden_prose_trace(spark, run_root):
    st = State(spark, run_root)
    full = [(1, "Nuri", 30), (2, "Odile", None), (3, None, 25), (4, "Pim", 35)]
    partial = [(1, "Nuri Smith", 31), (2, "Odile Johnson", 40), (9, "George", None)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("age", T.LongType())])
    mk = lambda rows: spark.createDataFrame(rows, schema).select("id", "name", F.col("age").cast("int"))
    full_load_job(st, mk(full), "2026-03-06 14:30:22", "parquet_full/20260306_143022")
    partial_load_job(st, mk(partial), "2026-03-06 15:00:00", "parquet_partial/20260306_150000")
    maintenance_job(st, "2026-03-06 15:05:00", order=("release",))
    maintenance_job(st, "2026-03-07 15:00:01", order=("expire",))
    clean = sorted((r.id, r.name, r.age) for r in st.read("clean").collect())
    assert clean == [(1, "Nuri Smith", 31), (2, "Odile Johnson", 40), (4, "Pim", 35)]
    statuses = sorted(r.quarantine_status for r in st.read("quarantine").collect())
    assert statuses == ["EXPIRED", "EXPIRED", "RELEASED", "RELEASED"]
    dead = st.read("dead_letter").collect()
    assert sorted(r.id for r in dead) == [3, 9]
    assert all(r.quarantine_status == "EXPIRED" for r in dead)

    hist = clean_history(st).collect()
    assert len(hist) == 4 and sum(h.is_current for h in hist) == 3
