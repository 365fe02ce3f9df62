"""Thin jobs: read state -> compose operators -> write new versions.

The operators never write; these functions do, from input versions that
are already on disk, so every job's lineage starts at parquet and a lost
executor only recomputes its own tasks.  Row counts come from
``Observation`` metrics collected while rows are written, not from extra
passes over the data.

State layout under ``root`` (a folder in the shared checkpoint space, see
``rowgate.session.run_dir``), written by ``rowgate.sources.tables``:

* ``clean/v=N/rg_bucket=B`` and ``clean_map/v=N`` -- key-hash buckets (see
  ``rowgate.sources.buckets``): a full load writes those whose digest changed, a
  merge reads and writes only those that hold its keys;
* ``quarantine/v=N/terminal=false|true`` -- each step reads only the live
  side of the newest version and writes the next version split in two:
  rows still live, and rows that became terminal (RELEASED / EXPIRED) in
  this step.  Terminal rows never change again, so the full quarantine
  table is the newest live side plus the terminal sides of all versions,
  and a pass costs O(live rows), not O(history);
* ``dead_letter/v=N`` -- append-only, each pass adds the rows it moved;
* ``released/v=N``, ``promoted/v=N`` -- the rows a pass released/promoted;
* ``changes/v=N`` -- the change feed of clean version N (S7): written by the
  job that wrote the version, from the keys it touched only (a merge diffs
  its batch's keys, not the table; a full load diffs the whole snapshot).
  ``clean_history`` folds it into the type-2 history.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import (
    BAD_TYPE_CODE_PREFIX,
    CHANGE_TYPE,
    COMMIT_TIMESTAMP,
    COMMIT_VERSION,
    DEFAULT_DATA_SCHEMA,
    EXPIRED,
    NULL_CODE_PREFIX,
    RELEASED,
    Params,
    change_schema,
    clean_schema,
    dead_letter_schema,
    quarantine_schema,
)
from rowgate.functions.rules import Rule, require_columns, type_rules
from rowgate.functions.widen import merged
from rowgate.operators import lifecycle as L
from rowgate.operators.history import scd2, snapshot_changes
from rowgate.operators.keyed import anti, latest_per_key, semi, upsert
from rowgate.operators.route import ERRORS, classify, split
from rowgate.sources import buckets, landing, tables
from rowgate.sources.claims import Claim, RunInProgress  # noqa: F401 - raised to callers
from rowgate.sources.landing import LandedFile, latest_per_area, unprocessed

_TERMINAL = T.StructType([T.StructField("terminal", T.BooleanType())])

_SCHEMAS = {
    "clean": clean_schema,
    "quarantine": quarantine_schema,
    "dead_letter": dead_letter_schema,
    "released": clean_schema,
    "promoted": clean_schema,
    "changes": change_schema,
    "ledger": lambda _data: LEDGER_SCHEMA,
}

# Tables that keep columns a batch has beyond the contract.
_EVOLVING = ("clean", "quarantine", "changes")

LEDGER_SCHEMA = T.StructType([
    T.StructField("area", T.StringType()),
    T.StructField("batch", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    # of a batch that came as files: one row a file; else null
    T.StructField("file", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("modified", T.LongType()),
])


@dataclass
class State:
    """Handle on the stored state of one pipeline.

    ``at`` pins a run: reads see versions ``<= at`` only and every write
    goes to version ``at + 1`` (replacing that folder).  A job that fails
    part-way -- driver lost between two writes, say -- is simply run again
    with the same ``at`` and produces the same versions.  Jobs pin a state
    that isn't (``pinned``): the last thing a run writes is its part of the
    ledger, so the newest ledger version is the last run that ended, and what
    a run left half-written is ignored and replaced by the next.
    """

    spark: SparkSession
    root: str
    data_schema: T.StructType = DEFAULT_DATA_SCHEMA
    params: Params = field(default_factory=Params)
    at: int | None = None
    written: dict = field(default_factory=dict)
    rows_per_bucket: int = 1_000_000  # of the clean table, which gets as many buckets as that takes
    stale_seconds: float = 7200  # a run that has held its claim for longer counts as lost
    claim: Claim | None = None

    def _schema(self, name: str) -> T.StructType:
        return _SCHEMAS[name](self.data_schema)

    def pinned(self) -> "State":
        """This state pinned at the last run that ended.  The first job pins it
        at the newest version of any table, as an empty part of the ledger."""
        if self.at is not None:
            return self
        vs = tables.versions(self.spark, self.root, "ledger")
        if not vs:
            vs = [0, *(v for name in _SCHEMAS for v in tables.versions(self.spark, self.root, name)[-1:])]
            tables.write(tables.empty(self.spark, LEDGER_SCHEMA), self.root, "ledger", version=max(vs))
        return replace(self, at=max(vs))

    def read(self, name: str) -> DataFrame:
        """The whole table (quarantine: live side plus every terminal side;
        dead letter: every part)."""
        if name == "quarantine":
            return self.read_live().unionByName(
                tables.read_parts(self.spark, self.root, name, self._schema(name), "terminal", _TERMINAL,
                                  max_version=self.at, evolve=True), allowMissingColumns=True)
        if name in ("dead_letter", "changes", "ledger"):
            return tables.read_parts(self.spark, self.root, name, self._schema(name), max_version=self.at, evolve=name in _EVOLVING)
        if name == "clean":
            return self._read_clean(self._layout())
        return tables.read(self.spark, self.root, name, self._schema(name), max_version=self.at)

    def _layout(self) -> buckets.Layout:
        return buckets.layout(self.spark, f"{self.root}/clean", self.at)

    def _read_clean(self, lay: buckets.Layout, hit: Sequence[int] | None = None) -> DataFrame:
        path, schema = f"{self.root}/clean", self._schema("clean")
        if lay.held:
            schema = tables.grown(self.spark, buckets.versions_in_use(path, lay), schema)
        return buckets.read(self.spark, path, schema, lay, hit)

    def _buckets_for(self, rows: int) -> int:
        return max(1, -(-rows // self.rows_per_bucket))

    def read_live(self) -> DataFrame:
        """Live side of the newest quarantine version (what every step works on)."""
        vs = [v for v in tables.versions(self.spark, self.root, "quarantine") if self.at is None or v <= self.at]
        schema = self._schema("quarantine")
        if not vs:
            return tables.empty(self.spark, schema)
        full = T.StructType(schema.fields + _TERMINAL.fields)
        df = tables.read(self.spark, self.root, "quarantine", full, version=vs[-1], evolve=True)
        return df.filter(~F.col("terminal")).drop("terminal")

    def next_version(self, name: str) -> int:
        """The version number this run's next write of ``name`` will get."""
        if self.at is not None:
            return self.at + 1
        vs = tables.versions(self.spark, self.root, name)
        return (vs[-1] + 1) if vs else 1

    def after(self) -> "State":
        """The state as this run left it (reads pinned to its last write)."""
        last = max(self.written.values()) if self.written else self.at
        return replace(self, at=last, written=dict(self.written))

    def read_written(self, name: str) -> DataFrame:
        """What this run wrote to ``name`` (for append-style tables: this
        step's rows); the newest version when the run wrote nothing."""
        return tables.read(self.spark, self.root, name, self._schema(name), version=self.written.get(name))

    def write(self, name: str, df: DataFrame, observe: dict[str, Column] | None = None) -> dict:
        """Write ``df`` as the next version of ``name``; return observed metrics.

        The clean table is written whole here; ``merge_clean`` writes parts of it.
        """
        if name == "clean":
            return {"clean_rows": self._write_clean(df, self._layout().buckets or 1, buckets.Layout(), None).rows}
        df = self._pin(name, df)
        part = None
        if name == "quarantine":
            live = F.col("quarantine_status").isin(*self.params.live, "FIXED")
            df = df.withColumn("terminal", ~live)
            part = ["terminal"]
        obs_arg = None
        if observe:
            obs = Observation(f"{name}_metrics")
            obs_arg = (obs, [v.alias(k) for k, v in observe.items()])
        version = None if self.at is None else self.at + 1
        self.last_version = tables.write(df, self.root, name, observe=obs_arg, partition_by=part, version=version)
        self.written[name] = self.last_version
        return dict(obs.get) if observe else {}

    def _pin(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` with the types of the contract, and its further columns where the table keeps them."""
        fields = self._schema(name).fields
        more = [c for c in df.columns if c not in self._schema(name).fieldNames()] if name in _EVOLVING else []
        return df.select(*[F.col(f.name).cast(f.dataType) for f in fields], *more)

    def _write_clean(self, df: DataFrame, n: int, lay: buckets.Layout, hit: Sequence[int] | None) -> buckets.Layout:
        """The next clean version: ``df`` in the buckets ``hit`` (None: all ``n``) of ``lay``."""
        v = self.next_version("clean")
        hit = range(n) if hit is None else hit
        lay = buckets.replace(self._pin("clean", df), self.params.keys, n, f"{self.root}/clean", v, lay, hit, digest=True)
        self.last_version = self.written["clean"] = v
        return lay

    def replace_clean(self, new: DataFrame, as_of: str, rows: int) -> dict:
        """Make ``new``, at most ``rows`` rows, the clean table: its next version and its
        change rows (same number).

        Only buckets whose digest differs are written and diffed; if none does, nothing
        is.  A table that has outgrown its buckets, or needs less than half of them, is
        dealt out anew.
        """
        lay, n = self._layout(), self._buckets_for(rows)
        if not lay.held or not lay.buckets <= 2 * n <= 4 * lay.buckets:
            old = self.read("clean")
            lay = self._write_clean(new, n, buckets.Layout(), None)
            return {"clean_rows": lay.rows, **self._write_changes(old, self._read_clean(lay), as_of)}
        keys = list(self.params.keys)
        hit = buckets.differing(self._pin("clean", new), keys, lay)
        if not hit:
            return {"clean_rows": lay.rows, "change_rows": 0}
        old = self._read_clean(lay, hit)
        changed = new.filter(buckets.bucket_of(keys, lay.buckets).isin(hit)) if len(hit) < lay.buckets else new
        lay = self._write_clean(changed, lay.buckets, lay, hit)
        return {"clean_rows": lay.rows, **self._write_changes(old, self._read_clean(lay, hit), as_of)}

    def clean_before(self, version: int, keys_df: DataFrame) -> DataFrame:
        """The clean rows of the given keys as they were before a version, from the buckets
        that the map of that time names."""
        lay = buckets.layout(self.spark, f"{self.root}/clean", version - 1)
        hit = buckets.hit_by(keys_df, self.params.keys, lay.buckets) if lay.held else []
        return semi(self._read_clean(lay, hit), keys_df, self.params.keys)

    def merge_clean(self, sources: Sequence[DataFrame], as_of: str, gone: DataFrame | None = None) -> dict:
        """Merge ``sources`` (each one row a key) one after another into the clean
        table: the next version and its change rows.  Rows of the keys ``gone`` are
        deleted first.

        Only the buckets of their keys are read and written, and only those keys
        are diffed.  A table that has outgrown its buckets is dealt out anew.
        """
        keys = list(self.params.keys)
        parts = [s.select(*keys) for s in ([] if gone is None else [gone]) + list(sources)]
        touched = functools.reduce(DataFrame.unionByName, parts).distinct()
        lay = self._layout()
        n = lay.buckets or 1
        if lay.rows > 2 * n * self.rows_per_bucket:
            n, hit = self._buckets_for(lay.rows), None
        else:
            hit = buckets.hit_by(touched, keys, n)
        old = self._read_clean(lay, hit)
        new = old if gone is None else anti(old, gone, keys)
        for s in sources:
            new = upsert(new, s, keys, dedupe_order=None)
        lay = self._write_clean(new, n, lay, hit)
        stored = self._read_clean(lay, hit)
        return {"clean_rows": lay.rows, **self._write_changes(semi(old, touched, keys), semi(stored, touched, keys), as_of)}

    def _write_changes(self, old: DataFrame, new: DataFrame, as_of: str) -> dict:
        v = self.last_version
        both = merged([old.schema, new.schema])  # a column that one side lacks is NULL there
        old, new = tables.conform(old, both), tables.conform(new, both)
        ch = self._pin("changes", snapshot_changes(old, new, list(self.params.keys), v, as_of, both.fieldNames()))
        obs = Observation("changes_metrics")
        tables.write(ch, self.root, "changes", version=v, observe=(obs, [_rows().alias("change_rows")]))
        self.written["changes"] = v
        return dict(obs.get)


def _rows() -> Column:
    return F.count(F.lit(1))


def create_all(state: State, with_history: bool = True) -> list[str]:
    """An empty first version of every contract table that does not
    exist yet (``CREATE TABLE IF NOT EXISTS``); returns the names created."""
    from rowgate.contracts import history_schema

    made = []
    for name in ("clean", "quarantine", "dead_letter"):
        if not tables.versions(state.spark, state.root, name):
            state.write(name, tables.empty(state.spark, state._schema(name)))
            made.append(name)
    if with_history and not tables.versions(state.spark, state.root, "history"):
        tables.write(tables.empty(state.spark, history_schema(state.data_schema)), state.root, "history")
        made.append("history")
    return made


def _one_at_a_time(job: Callable) -> Callable:
    """Run ``job`` on the pinned state while no other run works on the same version.

    A run claims the version it will write.  If another has it, ``RunInProgress`` is
    raised; if another ended between the pin and the claim, the job starts from the
    newer version.  A state that its caller has pinned (a stream's micro-batch id, a
    repeated run) is the caller's to guard.
    """

    @functools.wraps(job)
    def run(state: State, *args, **kwargs):
        if state.at is not None:
            return job(state, *args, **kwargs)
        while True:
            now = state.pinned()
            claim = Claim(state.spark, state.root, now.at + 1, state.stale_seconds)
            try:
                if tables.versions(state.spark, state.root, "ledger")[-1] == now.at:
                    return job(replace(now, claim=claim), *args, **kwargs)
            finally:
                claim.release()

    return run


_BAD = "_rg_bad_"


def at_edge(state: State, incoming: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """Pin the batch to the contract: every contract
    column must be present (V9, ``ValueError`` otherwise) and gets the contract
    type; other columns are kept as they are (``ValueError`` if one's type and that of the
    stored column don't go into one).  A value that doesn't cast fails the returned
    ``bad_type_<c>`` rules (V13) and its row goes to quarantine."""
    require_columns(incoming, state.data_schema.fieldNames())
    more = T.StructType([f for f in incoming.schema.fields if f.name not in state.data_schema.fieldNames()])
    if more.fields:
        merged([state.read("clean").schema, state.read("quarantine").schema, more])
    drift = [f for f in state.data_schema.fields if incoming.schema[f.name].dataType != f.dataType]
    casts = type_rules({f.name: (f.name, f.dataType.simpleString()) for f in drift})
    flags = {f"{_BAD}{f.name}": pred for f, (_, pred) in zip(drift, casts)}
    out = incoming.withColumns(flags).withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in drift})
    return out, [(code, F.col(flag)) for flag, (code, _) in zip(flags, casts)]


def _classified(state: State, incoming: DataFrame, live: DataFrame | None, source_file: str, rules: Sequence[Rule], path: str,
                observe: tuple | None = None) -> tuple[DataFrame, list[str]]:
    """Classify a batch once and keep it as a written table (lineage cut, one
    scan of the batch for both branches); also the names of its data columns."""
    p = state.params
    incoming, drift = at_edge(state, incoming)
    columns = list(p.columns or [c for c in incoming.columns if not c.startswith(_BAD)])
    v = classify(incoming, live, p, source_file, [*drift, *rules], stack=live is not None)
    for code, flag in drift:  # what doesn't cast isn't missing
        name = code.removeprefix(BAD_TYPE_CODE_PREFIX)
        name = incoming.select(flag).columns[0].removeprefix(_BAD)
        v = v.withColumn(ERRORS, F.when(flag, F.array_remove(ERRORS, f"{NULL_CODE_PREFIX}{name}")).otherwise(F.col(ERRORS)))
    if observe:
        v = v.observe(observe[0], *observe[1])
    v.write.mode("overwrite").parquet(path)
    return state.spark.read.schema(v.schema).parquet(path), columns


def _routed(state: State, incoming: DataFrame, as_of: str, source_file: str, stack: bool, rules: Sequence[Rule], part: str = "route",
            live: DataFrame | None = None):
    """Route a batch; with ``stack`` against the live keys of ``live``, or of the stored state."""
    if stack and live is None:
        live = state.read_live()
    path = f"{state.root}/staging/{part}/v={state.next_version('clean'):06d}"
    obs = Observation("route_metrics")
    bad = F.col("has_any_failure") | F.col("id_is_stacked")
    counts = [F.count_if(~bad).alias("clean_count"), F.count_if(bad).alias("quarantine_count"), _rows().alias("total_processed")]
    staged, columns = _classified(state, incoming, live if stack else None, source_file, rules, path, (obs, counts))
    return split(staged, columns, as_of, state.params.hours), dict(obs.get)


def _batch_of(source_file: str) -> tuple[str, str] | None:
    """(area, batch) of a source named ``area/yyyyMMdd_HHmmss``."""
    m = re.match(r"^([^/]+)/(\d{8}_\d{6})$", source_file)
    return (m[1], m[2]) if m else None


def _seen(state: State, batch: tuple[str, str] | None) -> bool:
    if batch is None:
        return False
    return state.read("ledger").filter((F.col("area") == batch[0]) & (F.col("batch") == batch[1])).limit(1).count() > 0


def _end_run(state: State, batches: Sequence[tuple[str, str]], as_of: str, files: Sequence[LandedFile] = ()) -> None:
    """The last write of every run: the batches it routed (maybe none), file by file
    where it knows the files."""
    by_file = {(f.area, f.batch) for f in files}
    rows = [(a, b, as_of, None, None, None) for a, b in batches if (a, b) not in by_file]
    rows += [(f.area, f.batch, as_of, f.file, f.size, f.modified) for f in files]
    done = state.spark.createDataFrame(rows, "area string, batch string, processed_at string, file string, size long, modified long")
    if state.claim:
        state.claim.check()
    state.write("ledger", done)


@_one_at_a_time
def full_load_job(state: State, incoming: DataFrame, as_of: str, source_file: str, stack: bool = False,
                  rules: Sequence[Rule] = (), order: Sequence[str] = ()) -> dict:
    """Clean rows replace the clean table (deleted keys show up as
    deletes in the change feed, L16); failing rows are appended.  Live keys
    are not consulted unless ``stack`` (R-12).  Of rows with one key the newest
    by ``order`` (then by all columns) stays.  A batch that the ledger has is
    skipped (S21)."""
    batch = _batch_of(source_file)
    if _seen(state, batch):
        return {"skipped": True}
    return _full_load(state, incoming, None, as_of, source_file, stack, rules, order, [batch] if batch else [], ())


def _full_load(state: State, incoming: DataFrame, late: DataFrame | None, as_of: str, source_file: str, stack: bool,
               rules: Sequence[Rule], order: Sequence[str], batches: Sequence[tuple[str, str]], files: Sequence[LandedFile]) -> dict:
    """``late``: of a folder that was loaded before, the rows of the files that came since;
    only their failing rows are new to the quarantine."""
    r, out = _routed(state, incoming, as_of, source_file, stack, rules)
    out.update(state.replace_clean(latest_per_key(r.clean, state.params.keys, order), as_of, out["clean_count"]))
    if late is not None:
        r, counts = _routed(state, late, as_of, source_file, stack, rules, "late")
        out["quarantine_count"] = counts["quarantine_count"]
    q = state.read_live().unionByName(r.quarantine, allowMissingColumns=True)
    out.update(state.write("quarantine", q, {"live_rows": _rows()}))
    _end_run(state, batches, as_of, files)
    return out


@_one_at_a_time
def partial_load_job(state: State, incoming: DataFrame, as_of: str, source_file: str, rules: Sequence[Rule] = (),
                     order: Sequence[str] = ()) -> dict:
    """R2: stacking route; clean rows merged on the key (newest by ``order``),
    the rest appended.  A batch that the ledger has is skipped (S21)."""
    batch = _batch_of(source_file)
    if _seen(state, batch):
        return {"skipped": True}
    return _partial_load(state, incoming, as_of, source_file, rules, order, [batch] if batch else [], ())


def _partial_load(state: State, incoming: DataFrame, as_of: str, source_file: str, rules: Sequence[Rule],
                  order: Sequence[str], batches: Sequence[tuple[str, str]], files: Sequence[LandedFile]) -> dict:
    r, out = _routed(state, incoming, as_of, source_file, True, rules)
    out.update(state.merge_clean([latest_per_key(r.clean, state.params.keys, order)], as_of))
    q = state.read_live().unionByName(r.quarantine, allowMissingColumns=True)
    out.update(state.write("quarantine", q, {"live_rows": _rows()}))
    _end_run(state, batches, as_of, files)
    return out


@_one_at_a_time
def load_folder_job(state: State, landing_root: str, area: str, as_of: str, full: bool, stack: bool = False,
                    rules: Sequence[Rule] = (), order: Sequence[str] = ()) -> dict:
    """R1 or R2 on the newest batch folder of an area, which may still be filling: the
    ledger tells the files that no run has loaded, and a run without any is skipped.
    A partial load routes the new files; a full load replaces the clean table by all
    files of the folder and adds the new files' failing rows to the quarantine."""
    names = landing.list_batches(state.spark, landing_root, area)
    if not names:
        raise FileNotFoundError(f"no batch folder found in {area}")
    there = landing.list_files(state.spark, landing_root, area, names[-1])
    new = landing.new_files(there, state.read("ledger"))
    if not new:
        return {"skipped": True}
    source, rows = f"{area}/{names[-1]}", landing.read_files(state.spark, landing_root, new)
    if not full:
        return _partial_load(state, rows, as_of, source, rules, order, [], new)
    late = rows if len(new) < len(there) else None
    return _full_load(state, landing.read_files(state.spark, landing_root, there), late, as_of, source, stack, rules, order, [], new)


def _runs_of(state: State, batch: tuple[str, str]) -> list[int]:
    """The versions of the runs that routed a batch (oldest first), which must have done
    nothing else: what another batch or a pass did there can't be told apart."""
    it = F.coalesce((F.col("area") == batch[0]) & (F.col("batch") == batch[1]), F.lit(False))
    parts = tables.read_parts(state.spark, state.root, "ledger", LEDGER_SCHEMA, max_version=state.at, with_version=True)
    runs = parts.groupBy("v").agg(F.max(it).alias("it"), F.max(~it).alias("more")).filter("it").collect()
    passes = set(tables.versions(state.spark, state.root, "released"))
    for r in runs:
        if r["more"] or r["v"] in passes:
            raise ValueError(f"version {r['v']} did more than route {'/'.join(batch)}")
    return sorted(r["v"] for r in runs)


@_one_at_a_time
def replay_job(state: State, incoming: DataFrame, as_of: str, source_file: str, full: bool = False, rules: Sequence[Rule] = (),
               order: Sequence[str] = ()) -> dict:
    """Route a batch again that was loaded before, as if the earlier tries hadn't been.

    The batch's live rows leave the quarantine.  Keys whose newest change in the feed is of
    an earlier try get the clean row they had before it (or none); keys that another run
    has changed since keep that run's row.  Then ``incoming`` is routed, all in one version,
    whose change rows are the difference in all.  With ``full`` the batch replaces the clean
    table.  What a pass has released or expired since stays so, and rows of later batches
    that were held back for a key of this one wait for the next pass.

    ``ValueError``: the ledger doesn't have the batch, or a run did more than route it.
    """
    batch = _batch_of(source_file)
    tries = _runs_of(state, batch) if batch else []
    if not tries:
        raise ValueError(f"{source_file} has not been loaded")
    live = state.read_live().filter(~F.col("source_file").eqNullSafe(F.lit(source_file)))
    r, out = _routed(state, incoming, as_of, source_file, not full, rules, live=live)
    clean = latest_per_key(r.clean, state.params.keys, order)
    if full:
        out.update(state.replace_clean(clean, as_of, out["clean_count"]))
    else:
        undone = _undone(state, tries)
        before = [state.clean_before(v, undone.filter(F.col("_since") == v)) for v in tries]
        out.update(state.merge_clean([functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), before), clean], as_of, undone))
    out.update(state.write("quarantine", live.unionByName(r.quarantine, allowMissingColumns=True), {"live_rows": _rows()}))
    _end_run(state, [batch], as_of)
    return out


def _undone(state: State, tries: Sequence[int]) -> DataFrame:
    """Keys whose newest change is of one of the versions ``tries``: the key and, ``_since``,
    the oldest of them after the last change of another version.  Kept as a written table."""
    keys, v = list(state.params.keys), F.col(COMMIT_VERSION)
    # parts of the feed before the first try aren't read
    feed = tables.read_parts(state.spark, state.root, "changes", state._schema("changes"), f"v >= {tries[0]}", max_version=state.at)
    own = v.isin(list(tries))
    others = semi(feed.filter(~own), feed.filter(own), keys).groupBy(*keys).agg(F.max(v).alias("_other"))
    left = feed.filter(own).join(others, keys, "left").filter(F.col("_other").isNull() | (v > F.col("_other")))
    path = f"{state.root}/staging/undone/v={state.next_version('clean'):06d}"
    out = left.groupBy(*keys).agg(F.min(v).alias("_since"))
    out.write.mode("overwrite").parquet(path)
    return state.spark.read.schema(out.schema).parquet(path)


@_one_at_a_time
def maintenance_job(state: State, as_of: str, order=("expire", "release", "promote")) -> dict:
    """L17 as a job: expire -> release -> promote from one input version and
    one ``as_of`` (R-8, R-19)."""
    out = _pass(state, as_of, order, state.read_live(), [])
    _end_run(state, [], as_of)
    return out


def _not_stale(state: State, rows: DataFrame, since: dt.datetime | None) -> DataFrame:
    """Rows to merge, none from before ``since``, whose key has no clean row from a later load.

    A row quarantined at T must not overwrite what a load wrote after T: the
    change feed says when a key's clean row was last written.  Only its rows after
    ``since`` matter, so what is read follows the age of the live rows, not that of the table.
    """
    keys = list(state.params.keys)
    written = state.read("changes").filter(~F.col(CHANGE_TYPE).isin("delete", "update_preimage"))
    if since is not None:
        written = written.filter(F.col(COMMIT_TIMESTAMP) > F.lit(since).cast("timestamp_ntz"))
    last = semi(written, rows.select(*keys).distinct(), keys).groupBy(*keys).agg(F.max(COMMIT_TIMESTAMP).alias("_last"))
    fresh = F.col("_last").isNull() | (F.col("ingestion_timestamp") >= F.col("_last"))
    return rows.join(last, keys, "left").filter(fresh).drop("_last")


def _pass(state: State, as_of: str, order, quarantine: DataFrame, sources: Sequence[DataFrame]) -> dict:
    """One maintenance pass over ``quarantine``; writes each table once.

    The rows each step moves (dead letter, released, promoted) are written
    first and read back, so the status updates and the clean-table merge use
    the stored sets instead of recomputing them; the final quarantine and
    clean versions are written last.  ``sources`` are rows that go into the
    clean table before those of the pass.  If no row is to be merged the clean
    table isn't written at all.
    """
    p, out = state.params, {}
    keys = list(p.keys)

    @functools.cache
    def since(start=quarantine):
        """When the oldest live row came."""
        return start.filter(L.is_live(p)).agg(F.min("ingestion_timestamp")).first()[0]

    def merge(name: str) -> DataFrame:
        """The newest rows of a step that aren't older than their clean row."""
        stored = state.read_written(name)
        if not out[f"{name}_keys"]:
            return stored
        when = quarantine.select(*stored.columns, "ingestion_timestamp")
        newest = latest_per_key(semi(when, stored, keys), keys, ("ingestion_timestamp",)).select(*keys, "ingestion_timestamp")
        return _not_stale(state, stored.join(newest, keys), since()).drop("ingestion_timestamp")

    for step in order:
        if step == "expire":
            # the moved rows are this pass's dead-letter part (append-only)
            out.update(state.write("dead_letter", L.dead_letter_rows(quarantine, as_of, p), {"expired_rows": _rows()}))
            quarantine = L.mark_expired(quarantine, as_of, p)
        elif step == "release":
            out.update(state.write("released", L.latest_valid_per_key(quarantine, p), {"released_keys": _rows()}))
            fresh = merge("released")
            _, quarantine, _ = L.release_fixed(fresh, quarantine, p, released=state.read_written("released"))
            sources = [*sources, fresh] if out["released_keys"] else sources
        elif step == "promote":
            out.update(state.write("promoted", L.promoted_rows(quarantine, p), {"promoted_keys": _rows()}))
            fresh = merge("promoted")
            _, quarantine, _ = L.promote_blocked(fresh, quarantine, p, promoted=state.read_written("promoted"))
            sources = [*sources, fresh] if out["promoted_keys"] else sources
        else:
            raise ValueError(f"unknown step {step!r}")
    # skipped steps still get an (empty) part, so "newest part" always means this pass
    for step, name in (("expire", "dead_letter"), ("release", "released"), ("promote", "promoted")):
        if step not in order:
            state.write(name, tables.empty(state.spark, state._schema(name)))
    live = F.col("quarantine_status").isin(*p.live)
    out.update(state.write("quarantine", quarantine, {
        "live_rows": F.count_if(live),
        "newly_released_rows": F.count_if(F.col("quarantine_status") == RELEASED),
        "newly_expired_rows": F.count_if(F.col("quarantine_status") == EXPIRED),
    }))
    return out | (state.merge_clean(sources, as_of) if sources else {})


def clean_history(state: State, tracked: list[str] | None = None) -> DataFrame:
    """Type-2 history of the clean table from its change feed (C3-C5), with
    versions as the sequence (one job may write several at one ``as_of``).  Columns that
    the table got later are NULL in older versions and have the widest type that any had."""
    keys = list(state.params.keys)
    feed = state.read("changes")
    tracked = tracked or [c for c in feed.columns if c not in (*keys, CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)]
    return scd2(feed, keys, "_commit_version", tracked)


def summary_frame(state: State, as_of: str) -> DataFrame:
    """The pass summary as a one-row frame, aggregated from the written
    versions (parquet scans of the stored results, not a recomputation)."""
    from rowgate.operators.reports import one_row

    state = state.after()
    q = state.read("quarantine")
    return one_row(
        e=state.read_written("dead_letter").agg(_rows().alias("expired_rows")),
        r=state.read_written("released").agg(_rows().alias("released_keys")),
        p=state.read_written("promoted").agg(_rows().alias("promoted_keys")),
        c=state.read("clean").agg(_rows().alias("clean_rows")),
        q=q.agg(F.count_if(F.col("quarantine_status").isin(*state.params.live)).alias("live_rows"),
                F.count_if(F.col("quarantine_status") == RELEASED).alias("released_rows")),
    )


def _route_frames(state: State, batches: Sequence[tuple[str, str, DataFrame]], rules: Sequence[Rule]):
    """Route batches (area, name, rows) one after another: (each one's clean rows, live
    quarantine, the last batch's time); a later batch sees the keys an earlier one
    quarantined."""
    p = state.params
    sources, live, as_of = [], state.read_live(), None
    version = state.next_version("clean")
    for area, name, batch in batches:
        as_of = dt.datetime.strptime(name, "%Y%m%d_%H%M%S").strftime("%Y-%m-%d %H:%M:%S")
        path = f"{state.root}/staging/route/v={version:06d}/{area}_{name}"
        staged, columns = _classified(state, batch, live, f"{area}/{name}", rules, path)
        r = split(staged, columns, as_of, p.hours)
        sources.append(latest_per_key(r.clean, p.keys, ()))
        live = live.unionByName(r.quarantine, allowMissingColumns=True)
    return sources, live, as_of


def _of_batches(rows: DataFrame, names: Sequence[tuple[str, str]]) -> list[tuple[str, str, DataFrame]]:
    """Each batch's rows of a frame with ``area`` and ``batch`` columns."""
    return [(a, b, rows.filter((F.col("area") == a) & (F.col("batch") == b)).drop("area", "batch")) for a, b in names]


def _route(state: State, batches: Sequence[tuple[str, str, DataFrame]], rules: Sequence[Rule], files: Sequence[LandedFile] = ()) -> dict:
    sources, live, as_of = _route_frames(state, batches, rules)
    out = state.write("quarantine", live, {"live_rows": _rows()})
    out.update(state.merge_clean(sources, as_of))
    _end_run(state, [(a, b) for a, b, _ in batches], as_of, files)
    out["as_of"] = as_of
    return out


@_one_at_a_time
def route_batches(state: State, rows: DataFrame, names: Sequence[tuple[str, str]], rules: Sequence[Rule] = ()) -> dict:
    """Route several landing batches in the given order (R4) and write one
    new clean version (with its change rows) and one quarantine version.

    ``rows`` carries ``area`` and ``batch`` columns; each batch is classified
    once into a staged table, then split.  The stamp time of a batch is its
    folder time.  Batches that the ledger has are skipped (S21).
    """
    names = [n for n in names if not _seen(state, n)]
    return _route(state, _of_batches(rows, names), rules) if names else {}


@_one_at_a_time
def route_files(state: State, landing_root: str, files: Sequence[LandedFile], rules: Sequence[Rule] = ()) -> dict:
    """As ``route_batches``, for landed files: their batches oldest first, each read from
    its own files with their own columns and types.  Files that the ledger has are
    skipped (S21); more files of a batch that was routed before are routed now."""
    new = landing.new_files(files, state.read("ledger"))
    by_batch: dict[tuple[str, str], list[LandedFile]] = {}
    for f in sorted(new, key=lambda f: (f.batch, f.area, f.file)):
        by_batch.setdefault((f.area, f.batch), []).append(f)
    frames = [(a, b, landing.read_files(state.spark, landing_root, own)) for (a, b), own in by_batch.items()]
    return _route(state, frames, rules, new) if new else {}


@_one_at_a_time
def quality_check_job(state: State, rows: DataFrame, as_of: str, areas: tuple[str, ...] | None = None,
                      rules: Sequence[Rule] = ()) -> dict:
    """The quality-check job: newest batch of every area (S4) that the
    ledger has not seen (S21, R-13), routed area by area (R4), then the
    quality-check pass order release -> expire (L17, R-19), all from one
    stored version into the next, each table written once.  The ledger part
    comes last, so a run that broke off is run again from the same version."""
    newest = unprocessed(latest_per_area(rows), state.read("ledger"))
    rank = {a: i for i, a in enumerate(areas or ())}
    found = [(r["area"], r["batch"]) for r in newest.select("area", "batch").distinct().collect()]
    names = sorted(found, key=lambda ab: (rank.get(ab[0], len(rank)), ab[0], ab[1]))
    return _check(state, _of_batches(newest, names), as_of, rules)


def _check(state: State, batches: Sequence[tuple[str, str, DataFrame]], as_of: str, rules: Sequence[Rule], files: Sequence[LandedFile] = ()) -> dict:
    sources, live, _ = _route_frames(state, batches, rules)
    out = _pass(state, as_of, ("release", "expire"), live, sources)
    names = [(a, b) for a, b, _ in batches]
    _end_run(state, names, as_of, files)
    out["batches"] = names
    return out


@_one_at_a_time
def quality_check_from_root(state: State, landing_root: str, areas: tuple[str, ...], as_of: str, rules: Sequence[Rule] = ()) -> dict:
    """The quality-check job on landing folders: each area's newest batch is
    found by a folder listing and only its files that the ledger doesn't have
    are read (no scan of older batches).  Without new files nothing is done."""
    batches, files = [], []
    for area in areas:
        names = landing.list_batches(state.spark, landing_root, area)
        new = landing.new_files(landing.list_files(state.spark, landing_root, area, names[-1]), state.read("ledger")) if names else []
        if new:
            batches.append((area, names[-1], landing.read_files(state.spark, landing_root, new)))
            files += new
    return _check(state, batches, as_of, rules, files) if batches else {"batches": []}
