"""DuckDB views for the oracle SQL of ``__spark_entry__.oracle_sql``.

These are the bindings of FIXTURES.md §4 written as SQL, plus the audit
columns the Spark side adds (``validation_errors`` rendered as text,
``source_file``, ``ingestion_timestamp``).  ``with_views`` prepends only the
views a query uses, as one ``WITH`` clause, so every oracle is a single
statement over the pre-registered driver tables.
"""

from __future__ import annotations

import re

_NULL_CODES = (
    "concat_ws(',', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN name IS NULL THEN 'null_name' END, "
    "CASE WHEN age IS NULL THEN 'null_age' END)"
)
_NULL_REASON = (
    "concat_ws(', ', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN name IS NULL THEN 'null_name' END, "
    "CASE WHEN age IS NULL THEN 'null_age' END)"
)
LIVE = "('QUARANTINE', 'BLOCKED', 'ACTIVE')"
T0 = "CAST('2026-03-06 14:30:22' AS TIMESTAMP)"
T1 = "CAST('2026-03-06 15:00:00' AS TIMESTAMP)"
T2 = "CAST('2026-03-07 14:45:00' AS TIMESTAMP)"
TF2 = "CAST('2026-03-07 01:00:00' AS TIMESTAMP)"

VIEWS: dict[str, str] = {
    "landing_full": """
SELECT CASE WHEN c_custkey % 97 = 96 THEN NULL ELSE c_custkey END AS id,
       CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_name END AS name,
       CASE WHEN c_custkey % 5 = 2 THEN NULL ELSE CAST(18 + c_custkey % 60 AS INT) END AS age
FROM customer""",
    "landing_partial": """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name || ' v2' END AS name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(19 + c_custkey % 60 AS INT) END AS age
FROM customer WHERE c_custkey % 4 = 1
UNION ALL
SELECT c_custkey + 1000000 AS id, c_name AS name,
       CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE CAST(30 AS INT) END AS age
FROM customer WHERE c_custkey % 10 = 0""",
    "landing_full_2": """
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_custkey % 17 = 5 THEN NULL
            ELSE CAST(18 + c_custkey % 60 + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS INT) END AS age
FROM customer WHERE c_custkey % 9 <> 4""",
    "landing": """
SELECT id, name, age, 'parquet_full' AS area, '20260306_143022' AS batch FROM landing_full
UNION ALL SELECT id, name, age, 'parquet_partial', '20260306_150000' FROM landing_partial
UNION ALL SELECT id, name, age, 'parquet_full', '20260307_010000' FROM landing_full_2""",
    "quarantine_0": f"""
SELECT id, name, age,
       {T0} AS quarantine_timestamp,
       {T0} + INTERVAL '24' HOUR AS quarantine_expiry,
       'QUARANTINE' AS quarantine_status,
       {_NULL_CODES} AS validation_errors,
       {_NULL_REASON} AS quarantine_reason,
       0 AS fix_attempts,
       'parquet_full/20260306_143022' AS source_file,
       {T0} AS ingestion_timestamp
FROM landing_full WHERE id IS NULL OR name IS NULL OR age IS NULL""",
    "live_0": "SELECT DISTINCT id AS live_id FROM quarantine_0 WHERE id IS NOT NULL",
    "routed_partial": """
SELECT id, name, age,
       (id IS NULL OR name IS NULL OR age IS NULL) AS has_any_null,
       live_id IS NOT NULL AS id_is_stacked
FROM landing_partial LEFT JOIN live_0 ON id = live_id""",
    "quarantine_p": f"""
SELECT id, name, age,
       {T1} AS quarantine_timestamp,
       {T1} + INTERVAL '24' HOUR AS quarantine_expiry,
       CASE WHEN has_any_null THEN 'QUARANTINE' ELSE 'BLOCKED' END AS quarantine_status,
       CASE WHEN has_any_null THEN {_NULL_CODES} ELSE 'id_already_quarantined' END AS validation_errors,
       CASE WHEN has_any_null THEN {_NULL_REASON} ELSE 'ID already quarantined (ID Stacking)' END AS quarantine_reason,
       0 AS fix_attempts,
       'parquet_partial/20260306_150000' AS source_file,
       {T1} AS ingestion_timestamp
FROM routed_partial WHERE has_any_null OR id_is_stacked""",
    "quarantine_1": "SELECT * FROM quarantine_0 UNION ALL SELECT * FROM quarantine_p",
    "clean_0": "SELECT id, name, age FROM landing_full WHERE id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL",
    "clean_partial": "SELECT id, name, age FROM routed_partial WHERE NOT has_any_null AND NOT id_is_stacked",
    "clean_1": """
SELECT id, name, age FROM clean_0 WHERE NOT EXISTS (SELECT 1 FROM clean_partial p WHERE p.id = clean_0.id)
UNION ALL
SELECT id, name, age FROM clean_partial""",
    "clean_2": "SELECT id, name, age FROM landing_full_2 WHERE id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL",
    "corrections": """
SELECT DISTINCT id, 'Fixed ' || CAST(id AS VARCHAR) AS name, CAST(40 AS INT) AS age
FROM quarantine_1 WHERE quarantine_status = 'QUARANTINE' AND id IS NOT NULL AND id % 3 = 0""",
    "after_expiry": f"""
SELECT id, name, age, quarantine_timestamp, quarantine_expiry,
       CASE WHEN quarantine_status IN {LIVE} AND quarantine_expiry < {T2} THEN 'EXPIRED' ELSE quarantine_status END
         AS quarantine_status,
       validation_errors, quarantine_reason, fix_attempts, source_file, ingestion_timestamp
FROM quarantine_1""",
    "dead_letter": f"""
SELECT id, name, age, quarantine_timestamp, quarantine_expiry, 'EXPIRED' AS quarantine_status, validation_errors,
       quarantine_reason, fix_attempts, source_file, ingestion_timestamp, {T2} AS moved_to_dead_letter
FROM quarantine_1 WHERE quarantine_status IN {LIVE} AND quarantine_expiry < {T2}""",
    # release pass on after_expiry (maintenance order expire -> release -> promote)
    "fixed_keys_e": f"""
SELECT DISTINCT id FROM after_expiry
WHERE quarantine_status IN {LIVE} AND id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL""",
    "released_e": f"""
SELECT id, name, age FROM (
  SELECT id, name, age, row_number() OVER (PARTITION BY id ORDER BY quarantine_timestamp DESC, ingestion_timestamp DESC,
         source_file DESC, name DESC NULLS LAST, age DESC NULLS LAST) AS rn
  FROM after_expiry
  WHERE quarantine_status IN {LIVE} AND id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL) z WHERE rn = 1""",
    "after_release": f"""
SELECT q.id, q.name, q.age, q.quarantine_timestamp, q.quarantine_expiry,
       CASE WHEN f.id IS NOT NULL AND q.quarantine_status IN {LIVE} THEN 'RELEASED' ELSE q.quarantine_status END
         AS quarantine_status,
       q.quarantine_reason,
       CASE WHEN f.id IS NOT NULL AND q.quarantine_status IN {LIVE} THEN q.fix_attempts + 1 ELSE q.fix_attempts END
         AS fix_attempts,
       q.source_file, q.ingestion_timestamp
FROM after_expiry q LEFT JOIN fixed_keys_e f ON q.id = f.id""",
    "promotable_r": """
SELECT DISTINCT id FROM after_release b WHERE quarantine_status = 'BLOCKED'
  AND NOT EXISTS (SELECT 1 FROM after_release q WHERE q.id = b.id AND q.quarantine_status = 'QUARANTINE')""",
    "final_quarantine": """
SELECT q.id, q.name, q.age, q.quarantine_timestamp, q.quarantine_expiry,
       CASE WHEN p.id IS NOT NULL AND q.quarantine_status = 'BLOCKED' THEN 'RELEASED' ELSE q.quarantine_status END
         AS quarantine_status,
       q.quarantine_reason, q.fix_attempts
FROM after_release q LEFT JOIN promotable_r p ON q.id = p.id""",
    "changes": """
SELECT user_id AS id, event_type, value, ts AS seq, event_id AS tiebreak,
       CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS change_type
FROM events""",
    "history_tracked": """
SELECT id, event_type, seq AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current FROM (
  SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq, tiebreak) AS nxt FROM (
    SELECT *, lag(event_type) OVER (PARTITION BY id ORDER BY seq, tiebreak) AS p1 FROM changes) l
  WHERE event_type IS DISTINCT FROM p1) k
WHERE change_type = 'upsert'""",
    "snapshot_changes": f"""
SELECT id, name, age, _change_type, CAST(2 AS BIGINT) AS _commit_version, {T1} AS _commit_timestamp FROM (
  SELECT coalesce(a.id, b.id) AS id, a.id IS NULL AS gone_new, b.id IS NULL AS gone_old,
         a.name AS n_name, a.age AS n_age, b.name AS o_name, b.age AS o_age
  FROM clean_1 a FULL OUTER JOIN clean_0 b ON a.id = b.id) d,
  LATERAL (SELECT n_name AS name, n_age AS age, 'insert' AS _change_type WHERE gone_old
           UNION ALL SELECT o_name, o_age, 'delete' WHERE gone_new
           UNION ALL SELECT o_name, o_age, 'update_preimage' WHERE NOT gone_old AND NOT gone_new
                 AND (n_name IS DISTINCT FROM o_name OR n_age IS DISTINCT FROM o_age)
           UNION ALL SELECT n_name, n_age, 'update_postimage' WHERE NOT gone_old AND NOT gone_new
                 AND (n_name IS DISTINCT FROM o_name OR n_age IS DISTINCT FROM o_age)) x
UNION ALL
SELECT id, name, age, _change_type, CAST(3 AS BIGINT), {TF2} FROM (
  SELECT coalesce(a.id, b.id) AS id, a.id IS NULL AS gone_new, b.id IS NULL AS gone_old,
         a.name AS n_name, a.age AS n_age, b.name AS o_name, b.age AS o_age
  FROM clean_2 a FULL OUTER JOIN clean_1 b ON a.id = b.id) d,
  LATERAL (SELECT n_name AS name, n_age AS age, 'insert' AS _change_type WHERE gone_old
           UNION ALL SELECT o_name, o_age, 'delete' WHERE gone_new
           UNION ALL SELECT o_name, o_age, 'update_preimage' WHERE NOT gone_old AND NOT gone_new
                 AND (n_name IS DISTINCT FROM o_name OR n_age IS DISTINCT FROM o_age)
           UNION ALL SELECT n_name, n_age, 'update_postimage' WHERE NOT gone_old AND NOT gone_new
                 AND (n_name IS DISTINCT FROM o_name OR n_age IS DISTINCT FROM o_age)) x""",
}

_ORDER = list(VIEWS)


def _deps(sql: str, seen: set[str]) -> None:
    for name in _ORDER:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            seen.add(name)
            _deps(VIEWS[name], seen)


def with_views(body: str) -> str:
    """``WITH <needed views> <body>`` as one statement."""
    needed: set[str] = set()
    _deps(body, needed)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in _ORDER if n in needed)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
