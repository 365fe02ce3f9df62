"""Streaming folds: a retried micro-batch leaves the same state, and a
late batch lands in place."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.operators.history import scd2
from rowgate.sources import bindings as B
from rowgate.streaming.history_stream import HistoryFold, current_history

SF = "/root/testdata/sf0.001"


def _fold(spark, root):
    ch = B.changes(spark, SF)
    hist = T.StructType([ch.schema["id"], ch.schema["event_type"],
                         T.StructField("valid_from", T.TimestampNTZType()),
                         T.StructField("valid_to", T.TimestampNTZType()),
                         T.StructField("is_current", T.BooleanType())])
    return ch, HistoryFold(root, ["id"], "seq", ["event_type"], "change_type", ["tiebreak"], ch.schema, hist, n_buckets=8)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_retried_and_late_batches(spark, run_root):
    ch, fold = _fold(spark, run_root)
    late = ch.filter(F.dayofmonth("seq") <= 10)
    rest = ch.filter(F.dayofmonth("seq") > 10)
    fold(rest, 0)
    fold(late, 1)
    once = _rows(current_history(spark, fold))
    fold(late, 1)  # the same micro-batch again, as after a failure before commit
    assert _rows(current_history(spark, fold)) == once
    expected = scd2(ch, ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"])
    assert once == _rows(expected.select(*current_history(spark, fold).columns))


@pytest.mark.parametrize("at", ["buckets", "map", "ended"])
def test_a_batch_that_broke_off_in_the_swap_is_run_again(spark, run_root, monkeypatch, at):
    """Stopped with half its buckets written, before its map, or after it: the state
    of the batch before stays whole, and the retry ends like a run without a stop."""
    from rowgate.sources import buckets, tables

    ch, fold = _fold(spark, run_root)
    thirds = [ch.filter(F.pmod(F.hash("id", "seq"), F.lit(3)) == n) for n in range(3)]
    fold(thirds[0], 0)
    fold(thirds[1], 1)
    before = _rows(current_history(spark, fold))

    def lost(*a, **k):
        raise RuntimeError("lost")

    real = tables.write
    if at == "buckets":
        def half(df, root, name, **k):
            real(df.filter(F.col(buckets.BUCKET) % 2 == 0), root, name, **k)
            lost()

        monkeypatch.setattr(tables, "write", half)
    elif at == "map":
        monkeypatch.setattr(tables, "write", lambda df, root, name, **k: lost() if name.endswith("_map") else real(df, root, name, **k))
    if at == "ended":
        fold(thirds[2], 2)
    else:
        with pytest.raises(RuntimeError):
            fold(thirds[2], 2)
        monkeypatch.undo()
        assert _rows(current_history(spark, fold)) == before
    fold(thirds[2], 2)
    expected = scd2(ch, ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"])
    assert _rows(current_history(spark, fold)) == _rows(expected.select(*current_history(spark, fold).columns))


def test_in_order_keys_read_no_log(spark, run_root, monkeypatch):
    """Rows after all that was seen are carried on from the open version; a late row has the
    log read in its key's bucket and from its own time on."""
    ch, fold = _fold(spark, run_root)
    asked = []
    real = HistoryFold._log_since
    monkeypatch.setattr(HistoryFold, "_log_since", lambda self, s, b, hit, at: asked.append((len(hit), at)) or real(self, s, b, hit, at))
    top = ch.agg(F.max("seq")).first()[0]
    cut = F.col("seq") < F.lit(top) - F.expr("INTERVAL 2 DAYS")
    fold(ch.filter(cut), 0)
    fold(ch.filter(~cut), 1)
    assert asked == []
    key = ch.first()["id"]
    late = ch.filter((F.col("id") == key) & cut).limit(1).withColumns({"event_type": F.lit("late"), "change_type": F.lit("upsert"), "seq": F.col("seq") + F.expr("INTERVAL 1 SECOND")})
    late = spark.createDataFrame(late.collect(), late.schema)
    fold(late, 2)
    assert asked == [(1, late.first()["seq"])]
    expected = scd2(ch.unionByName(late), ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"])
    assert _rows(current_history(spark, fold)) == _rows(expected.select(*current_history(spark, fold).columns))


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_arrival_gives_the_same_history(spark, run_root, seed):
    """Random rows of few keys in random batches: deletes, repeats, equal times, preimages,
    keys and sequence values that are null."""
    import random

    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice(["a", "b", None]), rnd.choice([None] + list(range(12)) * 4), n,
             rnd.choice(["upsert"] * 4 + ["delete", "delete", "update_preimage"])) for n in range(60)]
    schema = "id long, event_type string, seq long, tiebreak long, change_type string"
    ch = spark.createDataFrame(rows, schema)
    hist = T.StructType([ch.schema["id"], ch.schema["event_type"], T.StructField("valid_from", T.LongType()),
                         T.StructField("valid_to", T.LongType()), T.StructField("is_current", T.BooleanType())])
    fold = HistoryFold(run_root, ["id"], "seq", ["event_type"], "change_type", ["tiebreak"], ch.schema, hist, n_buckets=3)
    rnd.shuffle(rows)
    for n, at in enumerate(range(0, 60, 20)):
        fold(spark.createDataFrame(rows[at:at + 20], schema), n)
        expected = scd2(spark.createDataFrame(rows[:at + 20], schema), ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"])
        assert _rows(current_history(spark, fold)) == _rows(expected.select(*current_history(spark, fold).columns))


def test_replaced_buckets_are_deleted(spark, run_root):
    from rowgate.sources import buckets

    ch, fold = _fold(spark, run_root)
    for n in range(5):
        fold(ch.filter(F.pmod(F.hash("id", "seq"), F.lit(5)) == n), n)
    kept = [v for v, _ in buckets._folders(spark, fold.history_path)]
    assert sorted(kept) == [3, 4, 5]  # the two newest maps' versions at the last batch, and its own
    expected = scd2(ch, ["id"], "seq", ["event_type"], change_type="change_type", tiebreak=["tiebreak"])
    assert _rows(current_history(spark, fold)) == _rows(expected.select(*current_history(spark, fold).columns))


def test_landing_stream_publishes_change_feed(spark, run_root):
    from rowgate.plans.catalog import CONTRACT
    from rowgate.plans.jobs import State, clean_history
    from rowgate.streaming.landing_stream import LandingRouter, run_available

    land = f"{run_root}/landing"
    router = LandingRouter(f"{run_root}/state", land, CONTRACT, B.PARAMS)
    for df, src in ((B.landing_full(spark, SF), B.SOURCE_F), (B.landing_partial(spark, SF), B.SOURCE_P)):
        df.write.parquet(f"{land}/{src}")
        run_available(spark, router, f"{run_root}/checkpoint")
    st = State(spark, f"{run_root}/state", CONTRACT, B.PARAMS)
    assert sorted(map(tuple, st.read("clean").collect())) == sorted(map(tuple, B.clean_1(spark, SF).collect()))
    feed = st.read("changes").groupBy("_commit_version", "_change_type").count().collect()
    got = {(r["_commit_version"], r["_change_type"]): r["count"] for r in feed}
    # FIXTURES §5 at sf0.001: clean_0 has 102 rows; clean_0 -> clean_1 inserts 7, updates 23
    assert got == {(1, "insert"): 102, (2, "insert"): 7, (2, "update_preimage"): 23, (2, "update_postimage"): 23}
    assert clean_history(st).filter("is_current").count() == 109


def test_landing_stream_by_time_and_file_count(spark, run_root):
    """A running trigger with one file a micro-batch ends in the state of a single run."""
    from rowgate.plans.catalog import CONTRACT
    from rowgate.plans.jobs import State
    from rowgate.sources import bindings as B
    from rowgate.streaming import landing_stream as LS

    sf, land, got = "/root/testdata/sf0.001", f"{run_root}/landing", []
    for df, src in ((B.landing_full(spark, sf), B.SOURCE_F), (B.landing_partial(spark, sf), B.SOURCE_P)):
        df.coalesce(1).select([df[f.name].cast(f.dataType) for f in CONTRACT.fields]).write.parquet(f"{land}/{src}")
    for name, every in (("once", None), ("timed", "1 second")):
        router = LS.LandingRouter(f"{run_root}/{name}", land, CONTRACT, B.PARAMS)
        q = LS.start(spark, router, f"{run_root}/{name}-checkpoint", every=every, max_files=1)
        if every:
            q.processAllAvailable()
            q.stop()
        q.awaitTermination()
        got.append(sorted(map(str, State(spark, f"{run_root}/{name}", CONTRACT, B.PARAMS).read("quarantine").collect())))
    assert got[0] == got[1] and got[0]


def test_a_folder_in_parts_loses_no_row(spark, run_root):
    """Two files of a folder in two micro-batches, then a late one: all rows arrive."""
    from rowgate.plans.catalog import CONTRACT
    from rowgate.plans.jobs import State
    from rowgate.streaming import landing_stream as LS

    land = f"{run_root}/landing"
    router = LS.LandingRouter(f"{run_root}/state", land, CONTRACT, B.PARAMS)
    at = 0
    for files in (2, 1):
        for _ in range(files):
            spark.createDataFrame([(at + i, "a", i or None) for i in range(10)], "id long, name string, age int").coalesce(1).write.mode("append").parquet(f"{land}/{B.SOURCE_P}")
            at += 10
        LS.run_available(spark, router, f"{run_root}/checkpoint", max_files=1)
    st = State(spark, f"{run_root}/state", CONTRACT, B.PARAMS)
    assert sorted(r.id for r in st.read("clean").collect()) == [i for i in range(30) if i % 10]
    assert sorted(r.id for r in st.read("quarantine").collect()) == [0, 10, 20]


def test_landing_stream_makes_nothing_of_the_path_row_by_row(spark, run_root):
    """Paths are taken apart once a file: neither the stream's rows nor a long path cost a search each."""
    import re
    import time

    from rowgate.sources import landing as S
    from rowgate.streaming import landing_stream as LS

    land = f"{run_root}/landing"
    spark.range(10).coalesce(1).write.parquet(f"{land}/area/20260306_150000/deep/er")
    spark.range(10).coalesce(1).write.parquet(f"{land}/area/not-a-batch")
    stream = LS.landing_stream(spark, land)
    assert "regexp" not in stream._jdf.queryExecution().analyzed().toString()
    seen = []
    q = stream.writeStream.foreachBatch(lambda df, _: seen.extend(df.collect())).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None and len(seen) == 20  # a row for each row
    files = {S.landed_file(*r) for r in seen} - {None}
    assert files == set(S.list_files(spark, land, "area", "20260306_150000"))
    assert {f.file.rsplit("/", 1)[0] for f in files} == {"area/20260306_150000/deep/er"}
    began = time.perf_counter()
    assert re.search(S._PATH_RE, "x" * 50_000) is None
    assert time.perf_counter() - began < 1
