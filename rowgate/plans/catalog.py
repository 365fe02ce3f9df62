"""The query catalog: one Spark query per operator group,
each with the DuckDB SQL that must return the same rows.

Every query reads the driver tables of ``sf_dir`` through the bindings and
runs over whole tables.  Arrays are rendered as text and computed columns
are aliased identically on both sides so results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contracts import Params
from rowgate.functions.rules import render_codes, type_rules
from rowgate.functions.timeexpr import ts
from rowgate.operators import history as H
from rowgate.operators import lifecycle as L
from rowgate.operators import reports as R
from rowgate.operators.keyed import dedupe_latest, upsert
from rowgate.operators.route import append, classify, null_flags, route, validate
from rowgate.plans.oracle_views import LIVE, T2, with_views
from rowgate.sources import bindings as B
from rowgate.sources import landing as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

P = B.PARAMS
QCOLS = ["id", "name", "age", "quarantine_timestamp", "quarantine_expiry", "quarantine_status",
         "validation_errors", "quarantine_reason", "fix_attempts", "source_file", "ingestion_timestamp"]


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return deco


def rendered(df: DataFrame, cols=QCOLS) -> DataFrame:
    """Select ``cols`` with the error array rendered as text."""
    return df.select(*[render_codes(F.col(c)).alias(c) if c == "validation_errors" else F.col(c) for c in cols])


# --- landing (S1-S5, S21) ------------------------------------------------------

@query("latest_batch_rows", """
SELECT id, name, age, area, batch FROM landing
WHERE area = 'parquet_full' AND batch = (SELECT max(batch) FROM landing WHERE area = 'parquet_full')""")
def latest_batch_rows(spark, sf):
    return S.latest_batch(B.landing(spark, sf), area="parquet_full").select("id", "name", "age", "area", "batch")


@query("batch_inventory", f"""
SELECT area, batch, count(*) AS row_count, strptime(batch, '%Y%m%d_%H%M%S') AS batch_time,
       CAST(round((epoch({T2}) - epoch(strptime(batch, '%Y%m%d_%H%M%S'))) / 3600.0, 2) AS DOUBLE) AS hours_since
FROM landing GROUP BY area, batch""")
def batch_inventory(spark, sf):
    return S.batch_inventory(B.landing(spark, sf), B.T2).select("area", "batch", "row_count", "batch_time", "hours_since")


@query("latest_per_area", """
SELECT area, batch, id, name, age FROM landing
WHERE (area, batch) IN (SELECT area, max(batch) FROM landing GROUP BY area)""")
def latest_per_area(spark, sf):
    return S.latest_per_area(B.landing(spark, sf)).select("area", "batch", "id", "name", "age")


CONTRACT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType()),
])


@query("schema_contract_report", """
SELECT count(*) AS row_count, 'id' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type, 'ok' AS status,
       CAST(count_if(id IS NULL) AS BIGINT) AS null_rows, CAST(0 AS BIGINT) AS uncastable_rows FROM landing_full
UNION ALL SELECT count(*), 'name', 'string', 'string', 'ok', CAST(count_if(name IS NULL) AS BIGINT), 0 FROM landing_full
UNION ALL SELECT count(*), 'age', 'int', 'int', 'ok', CAST(count_if(age IS NULL) AS BIGINT), 0 FROM landing_full""")
def schema_contract_report(spark, sf):
    return S.schema_report(B.landing_full(spark, sf), CONTRACT)


# The columns of the four tables, in order.
_DATA = "id bigint, name string, age int"
_STAMPS = ("quarantine_timestamp timestamp_ntz, quarantine_expiry timestamp_ntz, quarantine_status string, "
           "validation_errors array<string>, quarantine_reason string, fix_attempts int, source_file string, "
           "ingestion_timestamp timestamp_ntz")
_TABLES = {
    "clean": _DATA,
    "quarantine": f"{_DATA}, {_STAMPS}",
    "dead_letter": f"{_DATA}, {_STAMPS}, moved_to_dead_letter timestamp_ntz",
    "history": f"{_DATA}, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
}


def _contract_sql() -> str:
    """Oracle for ``contract_tables``: the columns as stated above, joined with
    each table's row count computed from the SQL bindings.  The clean-table
    history count is the number of (key, version) runs: a key present in a
    snapshot starts a version when it was absent before or its values
    changed."""
    rows = []
    for table, columns in _TABLES.items():
        for i, (name, kind) in enumerate(c.split(" ") for c in columns.split(", ")):
            rows.append(f"('{table}', {i}, '{name}', '{kind}')")
    cols = ",\n  ".join(rows)
    return f"""
SELECT c.table_name, c.position, c.column_name, c.data_type, n.row_count
FROM (VALUES
  {cols}) AS c(table_name, position, column_name, data_type)
JOIN (
  SELECT 'clean' AS table_name, (SELECT count(*) FROM clean_1) AS row_count
  UNION ALL SELECT 'quarantine', (SELECT count(*) FROM quarantine_1)
  UNION ALL SELECT 'dead_letter', (SELECT count(*) FROM dead_letter)
  UNION ALL SELECT 'history', (
    SELECT CAST(count_if(p1) + count_if(p2 AND (NOT p1 OR n2 IS DISTINCT FROM n1 OR a2 IS DISTINCT FROM a1))
              + count_if(p3 AND (NOT p2 OR n3 IS DISTINCT FROM n2 OR a3 IS DISTINCT FROM a2)) AS BIGINT)
    FROM (SELECT a.id IS NOT NULL AS p1, a.name AS n1, a.age AS a1, b.id IS NOT NULL AS p2, b.name AS n2, b.age AS a2,
                 c.id IS NOT NULL AS p3, c.name AS n3, c.age AS a3
          FROM (SELECT id FROM clean_0 UNION SELECT id FROM clean_1 UNION SELECT id FROM clean_2) k
          LEFT JOIN clean_0 a ON a.id = k.id LEFT JOIN clean_1 b ON b.id = k.id LEFT JOIN clean_2 c ON c.id = k.id) i)
) n ON c.table_name = n.table_name"""


@query("contract_tables", _contract_sql())
def contract_tables(spark, sf):
    """The four contract tables instantiated over real states; one
    row per (table, column) with the table's row count."""
    from rowgate.contracts import CONTRACTS
    from rowgate.sources.tables import conform

    q1, c1 = stored(B.quarantine_1(spark, sf), "quarantine"), stored(B.clean_1(spark, sf), "clean")
    frames = {
        "clean": c1,
        "quarantine": q1,
        "dead_letter": L.dead_letter_rows(q1, B.T2, P),
        "history": clean_history(spark, sf, c1),
    }
    out = None
    for name, df in frames.items():
        schema = CONTRACTS[name](CONTRACT)
        conformed = conform(df, schema)
        counted = conformed.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                                        F.lit(f.dataType.simpleString()).alias("data_type"))
                               for i, f in enumerate(schema.fields)])),
            "row_count",
        )
        out = counted if out is None else out.unionByName(counted)
    return out


@query("unprocessed_batches", """
SELECT area, batch, id, name, age FROM landing l
WHERE NOT EXISTS (SELECT 1 FROM quarantine_1 q WHERE q.source_file = l.area || '/' || l.batch)""")
def unprocessed_batches(spark, sf):
    ledger = S.ledger_from_sources(B.quarantine_1(spark, sf))
    return S.unprocessed(B.landing(spark, sf), ledger).select("area", "batch", "id", "name", "age")


# --- validation (V1-V14) -------------------------------------------------------

@query("null_flags", """
SELECT id, name, age, id IS NULL AS has_null_id, name IS NULL AS has_null_name, age IS NULL AS has_null_age,
       (id IS NULL OR name IS NULL OR age IS NULL) AS has_any_null FROM landing_full""")
def null_flags_q(spark, sf):
    return null_flags(B.landing_full(spark, sf), P.required)


_CODES = ("concat_ws(',', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN name IS NULL THEN 'null_name' END, "
          "CASE WHEN age IS NULL THEN 'null_age' END)")
_REASON = _CODES.replace("concat_ws(','", "concat_ws(', '")
_NERR = "CAST((id IS NULL)::INT + (name IS NULL)::INT + (age IS NULL)::INT AS INTEGER)"


@query("error_codes", f"""
SELECT id, name, age, {_CODES} AS validation_errors, {_REASON} AS quarantine_reason, {_NERR} AS error_count
FROM landing_full""")
def error_codes_q(spark, sf):
    v = validate(B.landing_full(spark, sf), P, flags=False)
    return v.select("id", "name", "age", render_codes(F.col("validation_errors")).alias("validation_errors"),
                    F.concat_ws(", ", "validation_errors").alias("quarantine_reason"),
                    F.size("validation_errors").alias("error_count"))


@query("validated_rows", f"""
SELECT id, name, age, id IS NULL AS has_null_id, name IS NULL AS has_null_name, age IS NULL AS has_null_age,
       (id IS NULL OR name IS NULL OR age IS NULL) AS has_any_null, {_CODES} AS validation_errors,
       'parquet_full/20260306_143022' AS source_file
FROM landing_full""")
def validated_rows(spark, sf):
    v = validate(B.landing_full(spark, sf), P, source_file=B.SOURCE_F)
    return v.select("id", "name", "age", "has_null_id", "has_null_name", "has_null_age", "has_any_null",
                    render_codes(F.col("validation_errors")).alias("validation_errors"), "source_file")


@query("quarantine_rows_full", "SELECT * FROM quarantine_0")
def quarantine_rows_full(spark, sf):
    return rendered(B.quarantine_0(spark, sf))


@query("append_evolved", """
SELECT *, CASE WHEN source_file = 'parquet_partial/20260306_150000' THEN 'partial' END AS load_type FROM quarantine_1""")
def append_evolved(spark, sf):
    q0 = B.quarantine_0(spark, sf)
    new_rows = B.partial_route(spark, sf).extra["quarantine_rows"].withColumn("load_type", F.lit("partial"))
    return rendered(append(q0, new_rows, evolve=True), QCOLS + ["load_type"])


@query("live_keys", f"SELECT DISTINCT id FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND id IS NOT NULL")
def live_keys_q(spark, sf):
    from rowgate.operators.route import live_keys

    return live_keys(B.quarantine_1(spark, sf), P)


@query("stack_split", """
SELECT id, name, age, has_any_null, id_is_stacked,
       CASE WHEN has_any_null OR id_is_stacked THEN 'quarantine' ELSE 'clean' END AS route
FROM routed_partial""")
def stack_split(spark, sf):
    v = classify(B.landing_partial(spark, sf), B.quarantine_0(spark, sf), P)
    return v.select("id", "name", "age", "has_any_null", "id_is_stacked",
                    F.when(F.col("has_any_failure") | F.col("id_is_stacked"), "quarantine").otherwise("clean").alias("route"))


@query("quarantine_rows_partial", "SELECT * FROM quarantine_p")
def quarantine_rows_partial(spark, sf):
    return rendered(B.partial_route(spark, sf).extra["quarantine_rows"])


@query("clean_rows_partial", "SELECT * FROM clean_partial")
def clean_rows_partial(spark, sf):
    return B.partial_route(spark, sf).extra["clean_rows"]


@query("full_load_clean", "SELECT * FROM clean_0")
def full_load_clean(spark, sf):
    return B.clean_0(spark, sf)


@query("custom_rules", f"""
SELECT id, name, age,
       concat_ws(',', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN name IS NULL THEN 'null_name' END,
                 CASE WHEN age IS NULL THEN 'null_age' END, CASE WHEN age > 70 THEN 'age_out_of_range' END)
         AS validation_errors,
       NOT (id IS NULL OR name IS NULL OR age IS NULL OR coalesce(age > 70, false)) AS is_valid
FROM landing_full""")
def custom_rules(spark, sf):
    rules = [("age_out_of_range", F.coalesce(F.col("age") > 70, F.lit(False)))]
    v = validate(B.landing_full(spark, sf), P, rules=rules, flags=False)
    return v.select("id", "name", "age", render_codes(F.col("validation_errors")).alias("validation_errors"),
                    (~F.col("has_any_failure")).alias("is_valid"))


@query("type_check", """
SELECT id, name, age_text, TRY_CAST(age_text AS INTEGER) AS age,
       concat_ws(',', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN name IS NULL THEN 'null_name' END,
                 CASE WHEN age_text IS NULL THEN 'null_age' END,
                 CASE WHEN age_text IS NOT NULL AND TRY_CAST(age_text AS INTEGER) IS NULL THEN 'bad_type_age' END)
         AS validation_errors
FROM (SELECT id, name, CASE WHEN id % 8 = 0 THEN 'n/a' ELSE CAST(age AS VARCHAR) END AS age_text FROM landing_full) t""")
def type_check(spark, sf):
    f = B.landing_full(spark, sf)
    raw = f.select("id", "name", F.when(F.col("id") % 8 == 0, F.lit("n/a")).otherwise(F.col("age").cast("string")).alias("age_text"))
    rules = [("null_age", F.col("age_text").isNull())] + type_rules({"age": ("age_text", "int")})
    v = validate(raw, Params(required=("id", "name")), rules=rules, flags=False)
    return v.select("id", "name", "age_text", F.col("age_text").try_cast("int").alias("age"),
                    render_codes(F.col("validation_errors")).alias("validation_errors"))


@query("dedupe_latest", """
SELECT user_id, event_type, event_id, ts, value, dup_count FROM (
  SELECT user_id, event_type, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn,
         count(*) OVER (PARTITION BY user_id, event_type) AS dup_count
  FROM events) z WHERE rn = 1""")
def dedupe_latest_q(spark, sf):
    e = B.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return dedupe_latest(e, ["user_id", "event_type"], ["ts", "event_id"], count_col="dup_count").select(
        "user_id", "event_type", "event_id", "ts", "value", "dup_count")


# --- routing composites (R1-R4, J1-J4) ---------------------------------------------

@query("upsert_clean", "SELECT * FROM clean_1")
def upsert_clean(spark, sf):
    return upsert(B.clean_0(spark, sf), B.partial_route(spark, sf).extra["clean_rows"], P.keys)


@query("route_two_areas", "SELECT * FROM quarantine_1")
def route_two_areas(spark, sf):
    """Each area's newest batch in turn through the shared router; later
    batches see keys quarantined by earlier ones."""
    q, clean = None, None
    for df, as_of, src in ((B.landing_full(spark, sf), B.T0, B.SOURCE_F),
                           (B.landing_partial(spark, sf), B.T1, B.SOURCE_P)):
        r = route(df, q, P, as_of, src, stack=True)
        q = append(q, r.quarantine)
        clean = r.clean if clean is None else upsert(clean, r.clean, P.keys)
    return rendered(q)


# --- lifecycle (L1-L17, J5, J6) ----------------------------------------------------

_ALL_PRESENT = "id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL"


@query("fixed_rows", f"""
SELECT id, name, age, quarantine_timestamp, quarantine_status, source_file FROM quarantine_1
WHERE quarantine_status IN {LIVE} AND {_ALL_PRESENT}""")
def fixed_rows_q(spark, sf):
    return L.fixed_rows(B.quarantine_1(spark, sf), P).select(
        "id", "name", "age", "quarantine_timestamp", "quarantine_status", "source_file")


@query("marked_fixed", f"""
SELECT q.id, q.name, q.age, q.quarantine_timestamp,
       CASE WHEN f.id IS NOT NULL AND q.quarantine_status IN {LIVE} THEN 'FIXED' ELSE q.quarantine_status END
         AS quarantine_status,
       CASE WHEN f.id IS NOT NULL AND q.quarantine_status IN {LIVE} THEN q.fix_attempts + 1 ELSE q.fix_attempts END
         AS fix_attempts,
       q.quarantine_reason
FROM quarantine_1 q
LEFT JOIN (SELECT DISTINCT id FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND {_ALL_PRESENT}) f ON q.id = f.id""")
def marked_fixed(spark, sf):
    return L.mark_fixed(B.quarantine_1(spark, sf), P).select(
        "id", "name", "age", "quarantine_timestamp", "quarantine_status", "fix_attempts", "quarantine_reason")


@query("latest_valid_per_key", f"""
SELECT id, name, age, quarantine_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY quarantine_timestamp DESC, ingestion_timestamp DESC,
         source_file DESC, name DESC NULLS LAST, age DESC NULLS LAST) AS rn
  FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND {_ALL_PRESENT}) z WHERE rn = 1""")
def latest_valid_per_key(spark, sf):
    return L.latest_valid_per_key(B.quarantine_1(spark, sf), P).select("id", "name", "age", "quarantine_timestamp")


@query("apply_corrections", f"""
SELECT q.id,
       CASE WHEN c.id IS NOT NULL AND q.quarantine_status IN {LIVE} THEN c.name ELSE q.name END AS name,
       CASE WHEN c.id IS NOT NULL AND q.quarantine_status IN {LIVE} THEN c.age ELSE q.age END AS age,
       q.quarantine_timestamp, q.quarantine_status, q.quarantine_reason,
       (c.id IS NOT NULL AND q.quarantine_status IN {LIVE}) AS corrected
FROM quarantine_1 q LEFT JOIN corrections c ON q.id = c.id""")
def apply_corrections(spark, sf):
    out = L.apply_corrections(B.quarantine_1(spark, sf), B.corrections(spark, sf), P)
    return out.select("id", "name", "age", "quarantine_timestamp", "quarantine_status", "quarantine_reason", "corrected")


@query("default_fill_release", f"""
SELECT f.id, f.name, f.age, f.quarantine_timestamp,
       CASE WHEN k.id IS NOT NULL AND f.quarantine_status IN {LIVE} THEN 'RELEASED' ELSE f.quarantine_status END
         AS quarantine_status
FROM (SELECT id,
             CASE WHEN quarantine_status IN {LIVE} THEN coalesce(name, 'Unknown') ELSE name END AS name,
             CASE WHEN quarantine_status IN {LIVE} THEN coalesce(age, 0) ELSE age END AS age,
             quarantine_timestamp, quarantine_status FROM quarantine_1) f
LEFT JOIN (SELECT DISTINCT id FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND id IS NOT NULL) k ON f.id = k.id""")
def default_fill_release(spark, sf):
    filled = L.fill_defaults(B.quarantine_1(spark, sf), {"name": "Unknown", "age": 0}, P)
    out = L.mark_released(filled, L.fixed_rows(filled, P), P)
    return out.select("id", "name", "age", "quarantine_timestamp", "quarantine_status")


_RELEASED_1 = f"""(SELECT id, name, age FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY quarantine_timestamp DESC, ingestion_timestamp DESC,
         source_file DESC, name DESC NULLS LAST, age DESC NULLS LAST) AS rn
  FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND {_ALL_PRESENT}) z WHERE rn = 1)"""


@query("release_fixed_clean", f"""
SELECT id, name, age FROM clean_1 c WHERE NOT EXISTS (SELECT 1 FROM {_RELEASED_1} r WHERE r.id = c.id)
UNION ALL SELECT id, name, age FROM {_RELEASED_1} r2""")
def release_fixed_clean(spark, sf):
    clean, _, _ = L.release_fixed(B.clean_1(spark, sf), B.quarantine_1(spark, sf), P)
    return clean


@query("dead_letter_rows", "SELECT * FROM dead_letter")
def dead_letter_rows(spark, sf):
    return rendered(L.dead_letter_rows(B.quarantine_1(spark, sf), B.T2, P), QCOLS + ["moved_to_dead_letter"])


_AFTER_COLS = ["id", "name", "age", "quarantine_timestamp", "quarantine_expiry", "quarantine_status",
               "quarantine_reason", "fix_attempts"]


@query("after_expiry", "SELECT " + ", ".join(_AFTER_COLS) + " FROM after_expiry")
def after_expiry(spark, sf):
    return L.mark_expired(B.quarantine_1(spark, sf), B.T2, P).select(*_AFTER_COLS)


def _after_expiry(spark, sf):
    return L.mark_expired(B.quarantine_1(spark, sf), B.T2, P)


@query("promoted_blocked", """
SELECT id, name, age FROM (
  SELECT b.*, row_number() OVER (PARTITION BY id ORDER BY quarantine_timestamp DESC, ingestion_timestamp DESC,
         source_file DESC, name DESC NULLS LAST, age DESC NULLS LAST) AS rn
  FROM after_expiry b WHERE quarantine_status = 'BLOCKED'
    AND NOT EXISTS (SELECT 1 FROM after_expiry q WHERE q.id = b.id AND q.quarantine_status = 'QUARANTINE')) z
WHERE rn = 1""")
def promoted_blocked(spark, sf):
    _, _, promoted = L.promote_blocked(B.clean_1(spark, sf), _after_expiry(spark, sf), P)
    return promoted


@query("recovered_dead_letter", f"""
SELECT id, name, age, {T2} AS quarantine_timestamp, {T2} + INTERVAL '24' HOUR AS quarantine_expiry,
       'QUARANTINE' AS quarantine_status, quarantine_reason, fix_attempts, source_file
FROM dead_letter""")
def recovered_dead_letter(spark, sf):
    moved = L.dead_letter_rows(B.quarantine_1(spark, sf), B.T2, P)
    return L.recover_dead_letter(moved, B.T2, P).select(
        "id", "name", "age", "quarantine_timestamp", "quarantine_expiry", "quarantine_status", "quarantine_reason",
        "fix_attempts", "source_file")


@query("reason_counts", f"""
SELECT CASE WHEN quarantine_status = 'EXPIRED' THEN 'expired' ELSE 'live' END AS row_group, quarantine_reason,
       count(*) AS row_count
FROM after_expiry WHERE quarantine_status = 'EXPIRED' OR quarantine_status IN {LIVE}
GROUP BY 1, 2""")
def reason_counts(spark, sf):
    return R.reason_counts(_after_expiry(spark, sf), P)


@query("delete_bad_keys", """
SELECT id, name, age FROM clean_1 c WHERE NOT EXISTS (SELECT 1 FROM quarantine_1 q WHERE q.id = c.id)""")
def delete_bad_keys(spark, sf):
    return L.delete_keys(B.clean_1(spark, sf), B.quarantine_1(spark, sf), P)


# --- summaries (H15-H17, L17) --------------------------------------------------------

@query("load_summary", """
SELECT (SELECT count(*) FROM landing_full) AS full_total,
       (SELECT count(*) FROM clean_0) AS full_clean,
       (SELECT count(*) FROM quarantine_0) AS full_quarantine,
       (SELECT count(*) FROM landing_partial) AS partial_total,
       (SELECT count(*) FROM clean_partial) AS partial_clean,
       (SELECT count(*) FROM quarantine_p) AS partial_quarantine,
       (SELECT count(*) FROM clean_0) AS clean_before,
       (SELECT count(*) FROM clean_1) AS clean_after,
       (SELECT count(*) FROM clean_1) - (SELECT count(*) FROM clean_0) AS merge_delta""")
def load_summary(spark, sf):
    f = route(B.landing_full(spark, sf), None, P, B.T0, B.SOURCE_F, stack=False).summary
    p = B.partial_route(spark, sf).summary
    before = B.clean_0(spark, sf).agg(F.count(F.lit(1)).alias("clean_before"))
    after = B.clean_1(spark, sf).agg(F.count(F.lit(1)).alias("clean_after"))
    row = R.one_row(
        f=f.select(F.col("total_processed").alias("full_total"), F.col("clean_count").alias("full_clean"),
                   F.col("quarantine_count").alias("full_quarantine")),
        p=p.select(F.col("total_processed").alias("partial_total"), F.col("clean_count").alias("partial_clean"),
                   F.col("quarantine_count").alias("partial_quarantine")),
        b=before, a=after,
    )
    return row.withColumn("merge_delta", F.col("clean_after") - F.col("clean_before"))


@query("frame_profile", """
SELECT (SELECT count(*) FROM landing_full) AS row_count, column_name, position, null_count, 3 AS column_count FROM (
  SELECT 'id' AS column_name, 0 AS position, (SELECT count(*) FROM landing_full WHERE id IS NULL) AS null_count
  UNION ALL SELECT 'name', 1, (SELECT count(*) FROM landing_full WHERE name IS NULL)
  UNION ALL SELECT 'age', 2, (SELECT count(*) FROM landing_full WHERE age IS NULL)) t""")
def frame_profile(spark, sf):
    return R.frame_profile(B.landing_full(spark, sf))


_MAINT_SQL = """
SELECT (SELECT count(*) FROM dead_letter) AS expired_rows,
       (SELECT count(*) FROM released_e) AS released_keys,
       (SELECT count(*) FROM promotable_r) AS promoted_keys,
       (SELECT count(*) FROM (SELECT id FROM clean_1 UNION SELECT id FROM released_e
                              UNION SELECT id FROM promotable_r) u) AS clean_rows,
       (SELECT count(*) FROM final_quarantine WHERE quarantine_status IN ('QUARANTINE', 'BLOCKED', 'ACTIVE')) AS live_rows,
       (SELECT count(*) FROM final_quarantine WHERE quarantine_status = 'RELEASED') AS released_rows"""


def maintenance_state(spark, sf):
    """Run the maintenance job on the stored state after F and P; return
    the state handle (new versions written under a fresh run folder)."""
    from rowgate.plans.jobs import State, maintenance_job
    from rowgate.session import run_dir

    st = State(spark, run_dir(spark, "maintenance"), CONTRACT, P)
    st.write("clean", B.clean_1(spark, sf))
    st.write("quarantine", B.quarantine_1(spark, sf))
    maintenance_job(st, B.T2)
    return st


@query("maintenance_summary", _MAINT_SQL)
def maintenance_summary(spark, sf):
    from rowgate.plans.jobs import summary_frame

    return summary_frame(maintenance_state(spark, sf), B.T2)


@query("promotion_pass", """
WITH p AS (SELECT id, name, age FROM (
  SELECT b.*, row_number() OVER (PARTITION BY id ORDER BY quarantine_timestamp DESC, ingestion_timestamp DESC,
         source_file DESC, name DESC NULLS LAST, age DESC NULLS LAST) AS rn
  FROM after_expiry b WHERE quarantine_status = 'BLOCKED'
    AND NOT EXISTS (SELECT 1 FROM after_expiry q WHERE q.id = b.id AND q.quarantine_status = 'QUARANTINE')) z
WHERE rn = 1)
SELECT id, name, age, 'clean' AS side FROM clean_1 WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.id = clean_1.id)
UNION ALL SELECT id, name, age, 'clean' FROM p
UNION ALL SELECT id, name, age, 'promoted' FROM p
UNION ALL SELECT id, name, age, CASE WHEN quarantine_status = 'BLOCKED' AND id IN (SELECT id FROM p) THEN 'RELEASED' ELSE quarantine_status END
FROM after_expiry""")
def promotion_pass(spark, sf):
    """L10 in a job: a pass expires the full load's rows and, without a release step before
    it, promotes the rows that were held back for their keys; clean table, promoted rows
    and every quarantine row with its status."""
    from rowgate.plans.jobs import full_load_job, maintenance_job, partial_load_job

    st = _state(spark, "promotion_pass")
    full_load_job(st, B.landing_full(spark, sf), B.T0, B.SOURCE_F)
    partial_load_job(st, B.landing_partial(spark, sf), B.T1, B.SOURCE_P)
    maintenance_job(st, B.T2, order=("expire", "promote"))
    cols = ["id", "name", "age"]
    rows = st.read("quarantine").select(*cols, F.col("quarantine_status").alias("side"))
    for name, side in (("clean", "clean"), ("promoted", "promoted")):
        rows = rows.unionByName(st.read(name).select(*cols, F.lit(side).alias("side")))
    return rows


# --- reports (H1-H14) ------------------------------------------------------------------

@query("status_breakdown", """
SELECT quarantine_status, count(*) AS row_count, count(DISTINCT id) AS unique_ids FROM after_expiry GROUP BY 1""")
def status_breakdown(spark, sf):
    return R.status_breakdown(_after_expiry(spark, sf))


@query("health_row", f"""
SELECT CAST(count_if(quarantine_status = 'ACTIVE') AS BIGINT) AS active, CAST(count_if(quarantine_status = 'QUARANTINE') AS BIGINT) AS quarantine,
       CAST(count_if(quarantine_status = 'BLOCKED') AS BIGINT) AS blocked, CAST(count_if(quarantine_status = 'FIXED') AS BIGINT) AS fixed,
       CAST(count_if(quarantine_status = 'RELEASED') AS BIGINT) AS released, CAST(count_if(quarantine_status = 'EXPIRED') AS BIGINT) AS expired,
       count(*) AS total, CAST(count_if(quarantine_status IN {LIVE}) AS BIGINT) AS live_total,
       CAST(count_if(quarantine_status IN {LIVE}) AS BIGINT) > 1000 AS high_volume_alert
FROM after_expiry""")
def health_row(spark, sf):
    return R.health_row(_after_expiry(spark, sf), P).select(
        "active", "quarantine", "blocked", "fixed", "released", "expired", "total", "live_total", "high_volume_alert")


_EXP_COLS = ["id", "name", "age", "quarantine_status", "quarantine_reason", "quarantine_expiry", "hours_remaining"]
_HOURS_LEFT = f"CAST(round((epoch(quarantine_expiry) - epoch({T2})) / 3600.0, 2) AS DOUBLE) AS hours_remaining"


@query("expiring_soon", f"""
SELECT id, name, age, quarantine_status, quarantine_reason, quarantine_expiry, {_HOURS_LEFT} FROM quarantine_1
WHERE quarantine_status IN {LIVE} AND quarantine_expiry < {T2} + INTERVAL '6' HOUR AND quarantine_expiry > {T2}
ORDER BY quarantine_expiry, id NULLS LAST, name NULLS LAST, age NULLS LAST LIMIT 10""")
def expiring_soon(spark, sf):
    return R.expiring(B.quarantine_1(spark, sf), B.T2, P).select(*_EXP_COLS)


@query("expiring_or_overdue", f"""
SELECT id, name, age, quarantine_status, quarantine_reason, quarantine_expiry, {_HOURS_LEFT} FROM quarantine_1
WHERE quarantine_status IN {LIVE} AND quarantine_expiry < {T2} + INTERVAL '6' HOUR
ORDER BY quarantine_expiry, id NULLS LAST, name NULLS LAST, age NULLS LAST LIMIT 10""")
def expiring_or_overdue(spark, sf):
    return R.expiring(B.quarantine_1(spark, sf), B.T2, P, lower_bound=False).select(*_EXP_COLS)


@query("live_by_hours_left", f"""
SELECT id, name, age, quarantine_status, quarantine_reason, quarantine_expiry, {_HOURS_LEFT} FROM quarantine_1
WHERE quarantine_status IN {LIVE}""")
def live_by_hours_left(spark, sf):
    return R.expiring(B.quarantine_1(spark, sf), B.T2, P, horizon_hours=None, lower_bound=False, limit=None).select(*_EXP_COLS)


@query("quality_rate", f"""
SELECT c AS clean_count, q AS live_quarantine, d AS dead_letter_count, c + q + d AS total_processed,
       CAST(round(c * 100.0 / nullif(c + q + d, 0), 2) AS DOUBLE) AS quality_rate_pct
FROM (SELECT (SELECT count(*) FROM clean_1) AS c,
             (SELECT count(*) FROM after_expiry WHERE quarantine_status IN {LIVE}) AS q,
             (SELECT count(*) FROM after_expiry WHERE quarantine_status = 'EXPIRED') AS d) m""")
def quality_rate(spark, sf):
    moved = L.dead_letter_rows(B.quarantine_1(spark, sf), B.T2, P)
    d = moved.agg(F.count(F.lit(1)).alias("dead_letter_count"))
    return R.quality_rate(B.clean_1(spark, sf), _after_expiry(spark, sf), d, P).select(
        "clean_count", "live_quarantine", "dead_letter_count", "total_processed", "quality_rate_pct")


@query("top_reasons", f"""
SELECT quarantine_status, quarantine_reason, count(*) AS row_count, count(DISTINCT id) AS unique_ids
FROM quarantine_1 WHERE quarantine_status IN {LIVE} GROUP BY 1, 2
ORDER BY row_count DESC, quarantine_status, quarantine_reason NULLS LAST LIMIT 10""")
def top_reasons(spark, sf):
    return R.top_reasons(B.quarantine_1(spark, sf), P)


@query("reason_ids", f"""
SELECT m.quarantine_reason, m.id, c.row_count FROM
  (SELECT DISTINCT quarantine_reason, id FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND id IS NOT NULL) m
  JOIN (SELECT quarantine_reason, count(*) AS row_count FROM quarantine_1 WHERE quarantine_status IN {LIVE}
        GROUP BY 1) c ON m.quarantine_reason = c.quarantine_reason""")
def reason_ids(spark, sf):
    return R.reason_members(B.quarantine_1(spark, sf), P).select("quarantine_reason", "id", "row_count")


@query("oldest_live", f"""
SELECT id, name, age, quarantine_status, quarantine_reason, quarantine_timestamp,
       CAST(round((epoch({T2}) - epoch(quarantine_timestamp)) / 3600.0, 2) AS DOUBLE) AS hours_quarantined
FROM quarantine_1 WHERE quarantine_status IN {LIVE}
ORDER BY quarantine_timestamp, id NULLS LAST, name NULLS LAST, age NULLS LAST LIMIT 10""")
def oldest_live(spark, sf):
    return R.oldest_live(B.quarantine_1(spark, sf), B.T2, P).select(
        "id", "name", "age", "quarantine_status", "quarantine_reason", "quarantine_timestamp", "hours_quarantined")


@query("stacked_keys", """
SELECT id, count(*) AS version_count, min(quarantine_timestamp) AS first_seen, max(quarantine_timestamp) AS last_seen,
       string_agg(DISTINCT quarantine_status, ',' ORDER BY quarantine_status) AS statuses
FROM quarantine_1 WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""")
def stacked_keys(spark, sf):
    return R.stacked_keys(B.quarantine_1(spark, sf), P)


@query("daily_trend", f"""
SELECT CAST(quarantine_timestamp AS DATE) AS quarantine_date, count(*) AS quarantined_count,
       CAST(count_if(quarantine_status = 'RELEASED') AS BIGINT) AS released_count,
       CAST(count_if(quarantine_status = 'EXPIRED') AS BIGINT) AS expired_count,
       CAST(count_if(quarantine_status IN {LIVE}) AS BIGINT) AS live_count
FROM final_quarantine GROUP BY 1""")
def daily_trend(spark, sf):
    return R.daily_trend(maintenance_state(spark, sf).read("quarantine"), P)


@query("key_trail", """
SELECT id, name, age, quarantine_timestamp, quarantine_status, quarantine_reason FROM quarantine_1
WHERE id IN (SELECT id FROM quarantine_1 WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)""")
def key_trail(spark, sf):
    return R.key_trail(B.quarantine_1(spark, sf), P).select(
        "id", "name", "age", "quarantine_timestamp", "quarantine_status", "quarantine_reason")


def stored(df: DataFrame, name: str) -> DataFrame:
    """A state as the jobs keep it: written once, then read."""
    from rowgate.session import run_dir
    from rowgate.sources import tables

    root = run_dir(df.sparkSession, "stored")
    tables.write(df, root, name)
    return tables.read(df.sparkSession, root, name, df.schema)


def clean_history(spark, sf, c1: DataFrame) -> DataFrame:
    """Type-2 history of the clean table from its stored change feed: v1 (full load,
    all inserts), v2 (partial merge to ``c1``), v3 (second full load)."""
    c0, c2 = stored(B.clean_0(spark, sf), "clean"), stored(B.clean_2(spark, sf), "clean")
    empty = c0.filter(F.lit(False))
    feed = (H.snapshot_changes(empty, c0, P.keys, 1, B.T0)
            .unionByName(H.snapshot_changes(c0, c1, P.keys, 2, B.T1))
            .unionByName(H.snapshot_changes(c1, c2, P.keys, 3, B.FULL_2_TIME)))
    return H.scd2(stored(feed, "changes"), P.keys, "_commit_timestamp", ["name", "age"], tiebreak=["_commit_version"])


@query("verify_ids", f"""
SELECT (SELECT count(*) FROM corrections) AS n_ids,
       (SELECT count(*) FROM quarantine_1 q WHERE quarantine_status IN {LIVE}
          AND q.id IN (SELECT id FROM corrections)) AS live_in_quarantine,
       (SELECT count(*) FROM clean_1 c WHERE c.id IN (SELECT id FROM corrections)) AS in_clean,
       (SELECT count(*) FROM clean_2 h WHERE h.id IN (SELECT id FROM corrections)) AS current_in_history""")
def verify_ids(spark, sf):
    ids = B.corrections(spark, sf).select("id")
    c1 = stored(B.clean_1(spark, sf), "clean")
    q = L.keep_keys(stored(B.quarantine_1(spark, sf), "quarantine").filter(L.is_live(P)), ids, P)
    c = L.keep_keys(c1, ids, P)
    h = L.keep_keys(H.current(clean_history(spark, sf, c1)), ids, P)
    return R.one_row(
        n=ids.agg(F.count(F.lit(1)).alias("n_ids")),
        q=q.agg(F.count(F.lit(1)).alias("live_in_quarantine")),
        c=c.agg(F.count(F.lit(1)).alias("in_clean")),
        h=h.agg(F.count(F.lit(1)).alias("current_in_history")),
    )


# --- change feed and history (C1-C10) ---------------------------------------------------

@query("snapshot_changes", "SELECT * FROM snapshot_changes")
def snapshot_changes(spark, sf):
    c0, c1, c2 = B.clean_0(spark, sf), B.clean_1(spark, sf), B.clean_2(spark, sf)
    return H.snapshot_changes(c0, c1, P.keys, 2, B.T1).unionByName(H.snapshot_changes(c1, c2, P.keys, 3, B.FULL_2_TIME))


@query("net_changes", """
SELECT id, CASE WHEN _change_type <> 'delete' THEN name END AS name, CASE WHEN _change_type <> 'delete' THEN age END AS age,
       _change_type = 'delete' AS is_deleted, _commit_version AS last_commit_version FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY _commit_version DESC,
         CASE WHEN _change_type = 'delete' THEN 0 ELSE 1 END DESC) AS rn
  FROM snapshot_changes WHERE _change_type <> 'update_preimage') z WHERE rn = 1""")
def net_changes(spark, sf):
    return H.net_changes(snapshot_changes(spark, sf), P.keys)


def events_history(spark, sf, tracked) -> DataFrame:
    return H.scd2(B.changes(spark, sf), ["id"], "seq", tracked, change_type="change_type", tiebreak=["tiebreak"])


_HIST_ALL = """
SELECT id, event_type, value, seq AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current FROM (
  SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq, tiebreak) AS nxt FROM (
    SELECT *, lag(change_type) OVER w AS pc, lag(e) OVER w AS pe, lag(v) OVER w AS pv FROM (
      SELECT *, CASE WHEN change_type = 'delete' THEN NULL ELSE event_type END AS e,
                CASE WHEN change_type = 'delete' THEN NULL ELSE value END AS v FROM changes) c
    WINDOW w AS (PARTITION BY id ORDER BY seq, tiebreak)) l
  WHERE change_type IS DISTINCT FROM pc OR e IS DISTINCT FROM pe OR v IS DISTINCT FROM pv) k
WHERE change_type = 'upsert'"""


@query("history_from_events", _HIST_ALL)
def history_from_events(spark, sf):
    return events_history(spark, sf, ["event_type", "value"])


@query("history_tracked_subset", "SELECT * FROM history_tracked")
def history_tracked_subset(spark, sf):
    return events_history(spark, sf, ["event_type"])


@query("history_current", "SELECT id, event_type, valid_from FROM history_tracked WHERE valid_to IS NULL")
def history_current(spark, sf):
    return H.current(events_history(spark, sf, ["event_type"])).select("id", "event_type", "valid_from")


@query("history_days_active", """
SELECT id, event_type, valid_from, valid_to, CAST(CAST(valid_to AS DATE) - CAST(valid_from AS DATE) AS INTEGER) AS days_active
FROM history_tracked""")
def history_days_active(spark, sf):
    return H.days_active(events_history(spark, sf, ["event_type"])).select(
        "id", "event_type", "valid_from", "valid_to", "days_active")


@query("history_as_of", """
SELECT id, event_type, valid_from, valid_to FROM history_tracked
WHERE valid_from <= CAST('2024-01-15 00:00:00' AS TIMESTAMP)
  AND (valid_to > CAST('2024-01-15 00:00:00' AS TIMESTAMP) OR valid_to IS NULL)""")
def history_as_of(spark, sf):
    return H.as_of(events_history(spark, sf, ["event_type"]), B.AS_OF_DATE).select("id", "event_type", "valid_from", "valid_to")


# --- streams (C9, Q49) ------------------------------------------------------------------

@query("history_stream", _HIST_ALL)
def history_stream(spark, sf):
    """Q43 computed by a file stream: the change log arrives in three time
    slices out of order (middle, first, last) and the stream is restarted
    from its checkpoint after each."""
    from rowgate.session import run_dir
    from rowgate.streaming.history_stream import HistoryFold, current_history, run_available

    root = run_dir(spark, "history_stream")
    ch = B.changes(spark, sf)
    lo, hi = ch.agg(F.min("seq"), F.max("seq")).first()
    if lo is None:
        lo = hi = ts("1970-01-01 00:00:00")
    third = (hi - lo) / 3 if hi != lo else None
    cuts = [lo + third, lo + 2 * third] if third else [hi, hi]
    c1, c2 = ts(cuts[0]), ts(cuts[1])
    slices = [(F.col("seq") >= c1) & (F.col("seq") < c2), F.col("seq") < c1, F.col("seq") >= c2]
    tracked = ["event_type", "value"]
    hist_schema = T.StructType([ch.schema["id"], ch.schema["event_type"], ch.schema["value"],
                                T.StructField("valid_from", T.TimestampNTZType()),
                                T.StructField("valid_to", T.TimestampNTZType()),
                                T.StructField("is_current", T.BooleanType())])
    fold = HistoryFold(f"{root}/state", ["id"], "seq", tracked, "change_type", ["tiebreak"], ch.schema, hist_schema)
    src = f"{root}/source"
    for cond in slices:
        ch.filter(cond).write.mode("append").parquet(src)
        run_available(spark, src, fold, f"{root}/checkpoint")
    return current_history(spark, fold).select("id", "event_type", "value", "valid_from", "valid_to", "is_current")


@query("landing_stream", "SELECT * FROM quarantine_1")
def landing_stream_q(spark, sf):
    """Q21 computed by a file stream over landing folders: the full batch
    lands first, then the partial one; each run resumes from the checkpoint."""
    from rowgate.session import run_dir
    from rowgate.streaming.landing_stream import LandingRouter, run_available

    root = run_dir(spark, "landing_stream")
    land = f"{root}/landing"
    router = LandingRouter(f"{root}/state", land, CONTRACT, P)
    for df, src in ((B.landing_full(spark, sf), B.SOURCE_F), (B.landing_partial(spark, sf), B.SOURCE_P)):
        df.select([F.col(f.name).cast(f.dataType) for f in CONTRACT.fields]).write.parquet(f"{land}/{src}")
        run_available(spark, router, f"{root}/checkpoint")
    from rowgate.plans.jobs import State

    return rendered(State(spark, f"{root}/state", CONTRACT, P).read("quarantine"))


@query("clean_history_stream", """
SELECT a.id, a.name, a.age, CAST('2026-03-06 14:30:22' AS TIMESTAMP) AS valid_from,
       CASE WHEN b.id IS NULL OR b.name IS DISTINCT FROM a.name OR b.age IS DISTINCT FROM a.age
            THEN CAST('2026-03-06 15:00:00' AS TIMESTAMP) END AS valid_to,
       (b.id IS NOT NULL AND b.name IS NOT DISTINCT FROM a.name AND b.age IS NOT DISTINCT FROM a.age) AS is_current
FROM clean_0 a LEFT JOIN clean_1 b ON a.id = b.id
UNION ALL
SELECT b.id, b.name, b.age, CAST('2026-03-06 15:00:00' AS TIMESTAMP), CAST(NULL AS TIMESTAMP), TRUE
FROM clean_1 b LEFT JOIN clean_0 a ON a.id = b.id
WHERE a.id IS NULL OR b.name IS DISTINCT FROM a.name OR b.age IS DISTINCT FROM a.age""")
def clean_history_stream(spark, sf):
    """C9 end to end: landing files -> routed by the landing stream, which
    writes the clean table and its change feed -> a second stream folds the
    feed into the type-2 history of the clean table (sequence = commit time).
    Both streams resume from their checkpoints after each landing batch."""
    from rowgate.contracts import change_schema
    from rowgate.session import run_dir
    from rowgate.streaming import history_stream as HS
    from rowgate.streaming import landing_stream as LS

    root = run_dir(spark, "clean_history_stream")
    land, state = f"{root}/landing", f"{root}/state"
    router = LS.LandingRouter(state, land, CONTRACT, P)
    hist_schema = T.StructType(CONTRACT.fields + [T.StructField("valid_from", T.TimestampNTZType()),
                                                  T.StructField("valid_to", T.TimestampNTZType()),
                                                  T.StructField("is_current", T.BooleanType())])
    fold = HS.HistoryFold(f"{root}/history", ["id"], "_commit_timestamp", ["name", "age"], "_change_type",
                          ["_commit_version"], change_schema(CONTRACT), hist_schema)
    for df, src in ((B.landing_full(spark, sf), B.SOURCE_F), (B.landing_partial(spark, sf), B.SOURCE_P)):
        df.select([F.col(f.name).cast(f.dataType) for f in CONTRACT.fields]).write.parquet(f"{land}/{src}")
        LS.run_available(spark, router, f"{root}/checkpoint_landing")
        HS.run_available(spark, f"{state}/changes", fold, f"{root}/checkpoint_history")
    return HS.current_history(spark, fold).select("id", "name", "age", "valid_from", "valid_to", "is_current")


@query("quality_check_summary", f"""
WITH q_f2 AS (SELECT id, name, age FROM landing_full_2 WHERE id IS NULL OR name IS NULL OR age IS NULL),
c_f2 AS (SELECT id, name, age FROM landing_full_2 WHERE id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL),
live AS (SELECT DISTINCT id FROM q_f2 WHERE id IS NOT NULL),
p AS (SELECT l.id, l.name, l.age, (l.id IS NULL OR l.name IS NULL OR l.age IS NULL) AS bad, v.id IS NOT NULL AS stacked
      FROM landing_partial l LEFT JOIN live v ON l.id = v.id),
q_all AS (SELECT id, name, age, CAST('2026-03-07 01:00:00' AS TIMESTAMP) AS stamped FROM q_f2
          UNION ALL SELECT id, name, age, CAST('2026-03-06 15:00:00' AS TIMESTAMP) FROM p WHERE bad OR stacked),
c_p AS (SELECT id FROM p WHERE NOT bad AND NOT stacked),
fixed AS (SELECT DISTINCT id FROM q_all WHERE {_ALL_PRESENT}),
after AS (SELECT id, CASE WHEN id IN (SELECT id FROM fixed) THEN 'RELEASED'
                          WHEN stamped + INTERVAL '24' HOUR < {T2} THEN 'EXPIRED' ELSE 'LIVE' END AS st FROM q_all),
cl AS (SELECT id FROM c_f2 UNION SELECT id FROM c_p UNION SELECT id FROM fixed),
newest AS (SELECT area, max(batch) AS batch FROM landing GROUP BY area)
SELECT (SELECT count(*) FROM newest) AS batches_routed,
       (SELECT count(*) FROM cl) AS clean_rows,
       (SELECT count(*) FROM after WHERE st = 'LIVE') AS live_rows,
       (SELECT count(*) FROM after WHERE st = 'RELEASED') AS released_rows,
       (SELECT count(*) FROM after WHERE st = 'EXPIRED') AS expired_rows,
       (SELECT count(*) FROM newest) AS ledger_rows""")
def quality_check_summary(spark, sf):
    """The quality-check job (S4, S21, R4, L17) over the three landing
    batches: the newest of each area is routed (full area first), then
    release -> expire at T2; one summary row read back from the state."""
    from rowgate.contracts import FULL_AREA, PARTIAL_AREA
    from rowgate.plans.jobs import State, quality_check_job
    from rowgate.session import run_dir

    st = State(spark, run_dir(spark, "quality_check"), CONTRACT, P)
    quality_check_job(st, B.landing(spark, sf), B.T2, areas=(FULL_AREA, PARTIAL_AREA))
    q = st.read("quarantine")
    return R.one_row(
        b=st.read("ledger").agg(F.count(F.lit(1)).alias("batches_routed")),
        c=st.read("clean").agg(F.count(F.lit(1)).alias("clean_rows")),
        q=q.agg(F.count_if(F.col("quarantine_status").isin(*P.live)).alias("live_rows"),
                F.count_if(F.col("quarantine_status") == "RELEASED").alias("released_rows"),
                F.count_if(F.col("quarantine_status") == "EXPIRED").alias("expired_rows")),
        l=st.read("ledger").agg(F.count(F.lit(1)).alias("ledger_rows")),
    )


# --- jobs on stored state ------------------------------------------------------

def _state(spark, name, schema=CONTRACT, params=P):
    from rowgate.plans.jobs import State
    from rowgate.session import run_dir

    return State(spark, run_dir(spark, name), schema, params)


@query("load_then_check", "SELECT * FROM quarantine_0")
def load_then_check(spark, sf):
    """S21, R-13: a batch that the full load has routed is not routed again by
    the quality check that finds it as the newest of its area."""
    from rowgate.contracts import FULL_AREA
    from rowgate.plans.jobs import full_load_job, quality_check_job

    st = _state(spark, "load_then_check")
    landed = B.landing_full(spark, sf)
    full_load_job(st, landed, B.T0, B.SOURCE_F)
    quality_check_job(st, landed.withColumns({"area": F.lit(FULL_AREA), "batch": F.lit(B.BATCH_F)}), B.T1)
    return rendered(st.read("quarantine"))


@query("load_with_rules", """
WITH l AS (SELECT id, name, CASE WHEN id % 9 = 0 THEN 'n/a' ELSE CAST(age AS VARCHAR) END AS age FROM landing_partial),
v AS (SELECT id, name, concat_ws(',',
        CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN name IS NULL THEN 'null_name' END,
        CASE WHEN age IS NULL THEN 'null_age' END, CASE WHEN age = 'n/a' THEN 'bad_type_age' END,
        CASE WHEN TRY_CAST(age AS INTEGER) > 75 THEN 'too_old' END) AS validation_errors,
        TRY_CAST(age AS INTEGER) AS age FROM l)
SELECT id, name, age, validation_errors, CASE WHEN validation_errors = '' THEN 'clean' ELSE 'quarantine' END AS side FROM v""")
def load_with_rules(spark, sf):
    """V12, V13 in a job: ages land as text, some of them no numbers, and a
    custom rule is given; rows that fail either go to quarantine."""
    from rowgate.plans.jobs import partial_load_job

    st = _state(spark, "load_with_rules")
    age = F.when(F.col("id") % 9 == 0, F.lit("n/a")).otherwise(F.col("age").cast("string"))
    rules = [("too_old", F.coalesce(F.col("age") > 75, F.lit(False)))]
    partial_load_job(st, B.landing_partial(spark, sf).withColumn("age", age), B.T1, B.SOURCE_P, rules=rules)
    cols = ["id", "name", "age"]
    q = st.read("quarantine").select(*cols, render_codes(F.col("validation_errors")).alias("validation_errors"), F.lit("quarantine").alias("side"))
    return q.unionByName(st.read("clean").select(*cols, F.lit("").alias("validation_errors"), F.lit("clean").alias("side")))


@query("evolved_state", """
WITH live AS (SELECT DISTINCT id FROM quarantine_0 WHERE id IS NOT NULL),
p AS (SELECT id FROM landing_partial WHERE id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL
      AND id NOT IN (SELECT id FROM live))
SELECT c.id, c.name, c.age, CASE WHEN p.id IS NOT NULL THEN c.id % 3 END AS segment
FROM clean_1 c LEFT JOIN p ON c.id = p.id""")
def evolved_state(spark, sf):
    """A batch with a further column; the stored clean table keeps it."""
    from rowgate.plans.jobs import full_load_job, partial_load_job

    st = _state(spark, "evolved_state")
    full_load_job(st, B.landing_full(spark, sf), B.T0, B.SOURCE_F)
    partial_load_job(st, B.landing_partial(spark, sf).withColumn("segment", F.col("id") % 3), B.T1, B.SOURCE_P)
    return st.read("clean").select("id", "name", "age", "segment")


# Three versions of the clean table: without the column, with it as INT for the rows that
# the partial batch merged, and as BIGINT for all; and the type-2 history of these.
_GROWING = f"""
WITH live AS (SELECT DISTINCT id FROM quarantine_0 WHERE id IS NOT NULL),
p AS (SELECT id FROM landing_partial WHERE {_ALL_PRESENT} AND id NOT IN (SELECT id FROM live)),
s AS (SELECT 1 AS v, id, name, age, CAST(NULL AS BIGINT) AS segment FROM clean_0
      UNION ALL SELECT 2, c.id, c.name, c.age, CASE WHEN p.id IS NOT NULL THEN c.id % 3 END FROM clean_1 c LEFT JOIN p ON c.id = p.id
      UNION ALL SELECT 3, id, name, age, CASE WHEN id % 2 = 0 THEN id % 3 ELSE id * 3000000000 END FROM clean_2),
grid AS (SELECT i.id, t.v, s.name, s.age, s.segment, s.id IS NOT NULL AS there
         FROM (SELECT DISTINCT id FROM s) i CROSS JOIN (VALUES (1), (2), (3)) t(v) LEFT JOIN s ON s.id = i.id AND s.v = t.v),
moved AS (SELECT * FROM grid QUALIFY v = 1 OR struct_pack(there, name, age, segment)
          IS DISTINCT FROM lag(struct_pack(there, name, age, segment)) OVER (PARTITION BY id ORDER BY v)),
told AS (SELECT *, lead(v) OVER (PARTITION BY id ORDER BY v) AS next FROM moved)
"""


def _growing(spark, sf, name, after=lambda state: None):
    """A state that took the three batches; ``after`` sees it after each."""
    from rowgate.plans.jobs import full_load_job, partial_load_job

    st = _state(spark, name)
    full_load_job(st, B.landing_full(spark, sf), B.T0, B.SOURCE_F)
    after(st)
    partial_load_job(st, B.landing_partial(spark, sf).withColumn("segment", (F.col("id") % 3).cast("int")), B.T1, B.SOURCE_P)
    after(st)
    wide = F.when(F.col("id") % 2 == 0, F.col("id") % 3).otherwise(F.col("id") * 3000000000)
    full_load_job(st, B.landing_full_2(spark, sf).withColumn("segment", wide), B.FULL_2_TIME, B.SOURCE_F2)
    after(st)
    return st


@query("evolved_history", _GROWING + """
SELECT id, name, age, segment, CAST(v AS BIGINT) AS valid_from, CAST(next AS BIGINT) AS valid_to, next IS NULL AS is_current
FROM told WHERE there""")
def evolved_history(spark, sf):
    """A column that comes with the second batch, and as a wider type with
    the third, goes through the change feed into the history."""
    from rowgate.plans.jobs import clean_history as history_of

    st = _growing(spark, sf, "evolved_history")
    return history_of(st).select("id", "name", "age", "segment", "valid_from", "valid_to", "is_current")


@query("evolved_history_stream", _GROWING + """,
clock AS (SELECT * FROM (VALUES (1, TIMESTAMP '2026-03-06 14:30:22'), (2, TIMESTAMP '2026-03-06 15:00:00'), (3, TIMESTAMP '2026-03-07 01:00:00')) t(v, stamp))
SELECT id, name, age, segment, a.stamp AS valid_from, b.stamp AS valid_to, next IS NULL AS is_current
FROM told JOIN clock a ON a.v = told.v LEFT JOIN clock b ON b.v = next WHERE there""")
def evolved_history_stream(spark, sf):
    """C9 with S9: the streamed history takes on columns and wider types that come into the
    change feed while it runs (its stored rows aren't rewritten for that)."""
    from rowgate.contracts import change_schema, history_schema
    from rowgate.session import run_dir
    from rowgate.streaming import history_stream as HS

    root = run_dir(spark, "evolved_history_stream")
    fold = HS.HistoryFold(f"{root}/history", ["id"], "_commit_timestamp", ["name", "age"], "_change_type",
                          ["_commit_version"], change_schema(CONTRACT), history_schema(CONTRACT))

    def follow(st):
        nonlocal fold
        fold = HS.run_available(spark, f"{st.root}/changes", fold, f"{root}/checkpoint", evolve=True)

    _growing(spark, sf, "evolved_history_stream", follow)
    return HS.current_history(spark, fold).select("id", "name", "age", "segment", "valid_from", "valid_to", "is_current")


@query("full_load_dedupe", """
SELECT user_id, event_id, event_type, ts FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def full_load_dedupe(spark, sf):
    """R1 on a batch with many rows per key: the newest by time stays."""
    from rowgate.plans.jobs import full_load_job

    rows = B.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    st = _state(spark, "full_load_dedupe", schema, Params(keys=("user_id",), required=("event_type",)))
    full_load_job(st, rows, B.T0, B.SOURCE_F, order=("ts", "event_id"))
    return st.read("clean").select("user_id", "event_id", "event_type", "ts")


@query("newest_from_folders", """
SELECT id, name, age, 'parquet_full' AS area, '20260307_010000' AS batch FROM landing_full_2
UNION ALL SELECT id, name, age, 'parquet_partial', '20260306_150000' FROM landing_partial""")
def newest_from_folders(spark, sf):
    """S1-S4 on real folders: each area's newest batch from a listing, files at
    any depth below it; other batches aren't read."""
    from rowgate.contracts import FULL_AREA, PARTIAL_AREA
    from rowgate.session import run_dir

    land = run_dir(spark, "newest_from_folders")
    B.landing_full(spark, sf).write.parquet(f"{land}/{B.SOURCE_F}")
    B.landing_partial(spark, sf).write.parquet(f"{land}/{B.SOURCE_P}")
    B.landing_full_2(spark, sf).withColumn("region", F.col("id") % 2).write.partitionBy("region").parquet(f"{land}/{B.SOURCE_F2}")
    parts = [S.read_newest(spark, land, area).select("id", "name", "age", "area", "batch") for area in (FULL_AREA, PARTIAL_AREA)]
    return parts[0].unionByName(parts[1])


@query("late_files", """
SELECT id, name, age, 'quarantine' AS side FROM quarantine_1
UNION ALL SELECT id, name, age, 'clean' FROM clean_1""")
def late_files(spark, sf):
    """Folders that fill over time.  Each area's folder gets its files in two
    parts and is loaded after each and once more; no row is lost or routed twice."""
    from rowgate.contracts import FULL_AREA, PARTIAL_AREA
    from rowgate.plans.jobs import load_folder_job

    st = _state(spark, "late_files")
    land = f"{st.root}/landing"
    first = F.coalesce(F.col("id") % 2 == 0, F.lit(False))
    for df, src, area, at in ((B.landing_full(spark, sf), B.SOURCE_F, FULL_AREA, B.T0), (B.landing_partial(spark, sf), B.SOURCE_P, PARTIAL_AREA, B.T1)):
        for part in (first, ~first):
            df.filter(part).write.mode("append").parquet(f"{land}/{src}")
            load_folder_job(st, land, area, at, full=area == FULL_AREA)
        load_folder_job(st, land, area, at, full=area == FULL_AREA)
    cols = ["id", "name", "age"]
    q = st.read("quarantine").select(*cols, F.lit("quarantine").alias("side"))
    return q.unionByName(st.read("clean").select(*cols, F.lit("clean").alias("side")))


@query("replayed_batch", """
SELECT id, name, age, 'quarantine' AS side FROM quarantine_1
UNION ALL SELECT id, name, age, 'clean' FROM clean_1""")
def replayed_batch(spark, sf):
    """A partial batch is loaded from a faulty file (ages shifted, names missing, keys
    that aren't in the right one) and replayed from the right one; the state is that
    without the first try."""
    from rowgate.plans.jobs import full_load_job, partial_load_job, replay_job

    st = _state(spark, "replayed_batch")
    full_load_job(st, B.landing_full(spark, sf), B.T0, B.SOURCE_F)
    right = B.landing_partial(spark, sf)
    shifted = right.withColumns({"age": F.col("age") + 1, "name": F.when(F.col("id") % 4 > 0, F.col("name"))})
    faulty = shifted.unionByName(shifted.withColumn("id", -F.col("id")))
    partial_load_job(st, faulty, B.T1, B.SOURCE_P)
    replay_job(st, right, B.T1, B.SOURCE_P)
    cols = ["id", "name", "age"]
    q = st.read("quarantine").select(*cols, F.lit("quarantine").alias("side"))
    return q.unionByName(st.read("clean").select(*cols, F.lit("clean").alias("side")))


@query("stream_in_parts", """
SELECT id, name, age, 'quarantine' AS side FROM quarantine_1
UNION ALL SELECT id, name, age, 'clean' FROM clean_1""")
def stream_in_parts(spark, sf):
    """S1, S21 in the stream: one file a micro-batch, folders of several files that are
    completed later, ages as BIGINT in some files and a further column in others."""
    from rowgate.plans.jobs import State
    from rowgate.session import run_dir
    from rowgate.streaming.landing_stream import LandingRouter, run_available

    root = run_dir(spark, "stream_in_parts")
    land = f"{root}/landing"
    router = LandingRouter(f"{root}/state", land, CONTRACT, P)
    part = F.coalesce(F.pmod(F.col("id"), F.lit(3)), F.lit(0))
    for df, src in ((B.landing_full(spark, sf), B.SOURCE_F), (B.landing_partial(spark, sf), B.SOURCE_P)):
        cut = [df.filter(part == n).coalesce(1) for n in range(3)]
        cut[1] = cut[1].withColumn("age", F.col("age").cast("bigint"))
        cut[2] = cut[2].withColumn("segment", F.lit("x"))
        for these in (cut[:2], cut[2:]):
            for c in these:
                c.write.mode("append").parquet(f"{land}/{src}")
            run_available(spark, router, f"{root}/checkpoint", max_files=1)
    st = State(spark, f"{root}/state", CONTRACT, P)
    cols = ["id", "name", "age"]
    q = st.read("quarantine").select(*cols, F.lit("quarantine").alias("side"))
    return q.unionByName(st.read("clean").select(*cols, F.lit("clean").alias("side")))


@query("pruned_full_load", """
SELECT id, name, CASE WHEN id % 50 = 0 THEN age + 1 ELSE age END AS age, 'now' AS side FROM clean_0
UNION ALL SELECT id, name, age, 'before' FROM clean_0 WHERE id % 50 = 0""")
def pruned_full_load(spark, sf):
    """A second full load of the batch with some ages changed; buckets are
    found by digest.  The clean table, and the images that the change feed says went."""
    from rowgate.contracts import CHANGE_TYPE
    from rowgate.plans.jobs import State, full_load_job
    from rowgate.session import run_dir

    st = State(spark, run_dir(spark, "pruned_full_load"), CONTRACT, P, rows_per_bucket=1000)
    landed = B.landing_full(spark, sf)
    full_load_job(st, landed, B.T0, B.SOURCE_F)
    changed = landed.withColumn("age", F.when(F.col("id") % 50 == 0, F.col("age") + 1).otherwise(F.col("age")))
    full_load_job(st, changed, B.FULL_2_TIME, B.SOURCE_F2)
    cols = ["id", "name", "age"]
    gone = st.read("changes").filter(F.col(CHANGE_TYPE).isin("update_preimage", "delete"))
    return st.read("clean").select(*cols, F.lit("now").alias("side")).unionByName(gone.select(*cols, F.lit("before").alias("side")))
