"""DuckDB twins of the ingestion / snapshot / retraining queries."""

from __future__ import annotations

from driftline.operators.quality import NUMERIC_PATTERN
from driftline.plans import ingest_queries as iq
from driftline.plans.oracle_drift import base_ctes

ROWS = """rows AS (
  SELECT event_id, ts AS "timestamp", value AS prediction_score, CAST(user_id AS DOUBLE) AS feature_1,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS feature_2,
         CASE WHEN event_type = 'error' THEN NULL ELSE value / CAST(10.0 AS DOUBLE) END AS feature_3,
         event_type, CAST(ts AS DATE) AS snapshot_date
  FROM events
)"""
COLS = ["event_id", "timestamp", "prediction_score", "feature_1", "feature_2", "feature_3", "event_type"]
DOUBLES = {"prediction_score", "feature_1", "feature_2", "feature_3"}
SEL = ", ".join(f'"{c}"' for c in COLS)


def _null(c: str) -> str:
    q = f'"{c}"'
    cond = f"({q} IS NULL OR isnan({q}))" if c in DOUBLES else f"{q} IS NULL"
    return f"avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END)::DOUBLE AS n_{c}"


def _pct(x: str) -> str:
    return f"printf('%.1f%%', round_even({x} * CAST(1000.0 AS DOUBLE), 0) / CAST(10.0 AS DOUBLE))"


def _agg() -> str:
    return (f"agg AS (SELECT snapshot_date, count(*) AS _rows, {', '.join(_null(c) for c in COLS)} "
            f"FROM rows GROUP BY snapshot_date)")


def dq_checks_sql() -> str:
    numeric = ["event_id", "prediction_score", "feature_1", "feature_2", "feature_3"]
    parts = [
        "SELECT snapshot_date, 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", "
        "CASE WHEN _rows < 10 THEN 'error' ELSE 'ok' END AS level, CAST(_rows AS DOUBLE) AS observed, "
        "CAST(10.0 AS DOUBLE) AS threshold, _rows >= 10 AS passed, "
        "CASE WHEN _rows < 10 THEN printf('Snapshot has %d rows; minimum required is %d.', _rows, 10) END AS message FROM agg",
        "SELECT snapshot_date, 'required_columns', NULL, 'ok', CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), true, NULL FROM agg",
    ]
    for c in numeric:
        parts.append(f"SELECT snapshot_date, 'numeric_type', '{c}', 'ok', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), true, NULL FROM agg")
    for c in COLS:
        r = f"n_{c}"
        parts.append(
            f"SELECT snapshot_date, 'null_rate', '{c}', CASE WHEN {r} > 0.1 THEN 'error' ELSE 'ok' END, {r}, "
            f"CAST(0.1 AS DOUBLE), NOT ({r} > 0.1), CASE WHEN {r} > 0.1 THEN 'Column ''{c}'' null rate ' || {_pct(r)} "
            f"|| ' exceeds threshold 10.0%.' END FROM agg")
    return f"WITH {ROWS}, {_agg()} " + " UNION ALL ".join(parts)


def ingest_sql() -> str:
    non_nullable = [c for c in COLS if c != "feature_3"]
    errs = " + ".join([f"CASE WHEN n_{c} > 0.05 THEN 1 ELSE 0 END" for c in non_nullable])
    return f"""WITH {ROWS}, {_agg()},
s AS (SELECT snapshot_date, _rows, CAST((CASE WHEN _rows < 10 THEN 1 ELSE 0 END) + {errs} AS BIGINT) AS errors,
             CAST(CASE WHEN n_feature_3 > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS warnings FROM agg)
SELECT snapshot_date, _rows AS rows_in, errors = 0 AS passed, errors, warnings,
       CASE WHEN errors = 0 THEN _rows ELSE 0 END AS rows_saved FROM s"""


def coerce_sql() -> str:
    pat = "(?i)" + NUMERIC_PATTERN

    def co(c):
        return f"CASE WHEN regexp_matches({c}, '{pat}') THEN TRY_CAST(trim({c}) AS DOUBLE) END AS {c}"
    return (f"SELECT event_id, {co('k_text')}, {co('type_text')}, {co('suffixed_text')}, {co('padded_text')} FROM ("
            "SELECT event_id, json_extract_string(props, '$.k') AS k_text, event_type AS type_text, "
            "CAST(value AS VARCHAR) || 'd' AS suffixed_text, ' ' || CAST(value AS VARCHAR) || ' ' AS padded_text "
            "FROM events)")


def decisions_sql() -> str:
    """The verdict of every day by the drift twins, then one step of the gate per run."""
    limits = iq.HISTORY_THRESHOLDS["psi"]
    tagged = f"""SELECT d.run_date AS scenario, 'b' AS side, r.* FROM r
  JOIN (SELECT DISTINCT snapshot_date AS run_date FROM r WHERE snapshot_date > DATE '{iq.HISTORY_BASELINE_LAST}') d
  ON r.snapshot_date <= DATE '{iq.HISTORY_BASELINE_LAST}'
  UNION ALL SELECT snapshot_date, 'c', r.* FROM r WHERE snapshot_date > DATE '{iq.HISTORY_BASELINE_LAST}'"""
    ctes = base_ctes(tagged_sql=tagged, features=iq.HISTORY_FEATURES, warning=limits["warning"], critical=limits["critical"],
                     shift=iq.HISTORY_THRESHOLDS["mean_shift_pct"])
    return f"""WITH RECURSIVE {ROWS.replace("rows AS (", "r AS (")},{ctes},
runs AS (SELECT 'inference' AS pipeline, scenario AS run_date, overall_status, should_alert, should_retrain,
                8 + day(scenario) % 3 * 6 AS hour, row_number() OVER (ORDER BY scenario) AS k FROM overall),
fold AS (
  SELECT *, crit AS n, crit >= 3 AND hour >= 8 AND hour < 18 AS granted
  FROM (SELECT *, CASE WHEN overall_status = 'critical' THEN 1 ELSE 0 END AS crit FROM runs WHERE k = 1) f
  UNION ALL
  SELECT pipeline, run_date, overall_status, should_alert, should_retrain, hour, k, crit, n, n >= 3 AND hour >= 8 AND hour < 18
  FROM (SELECT r.*, CASE WHEN r.overall_status = 'critical' THEN 1 ELSE 0 END AS crit,
               CASE WHEN f.granted THEN 0 ELSE f.n END + CASE WHEN r.overall_status = 'critical' THEN 1 ELSE 0 END AS n
        FROM fold f JOIN runs r ON r.k = f.k + 1) s
)"""


def oracle_queries() -> dict[str, str]:
    w = f"WITH {ROWS} "
    fmts = " UNION ALL ".join(
        f"SELECT '{f}' AS format, event_id, prediction_score, feature_2, feature_3, event_type FROM rows"
        for f in ("parquet", "csv", "json"))
    late = ", ".join(f"DATE '{d}'" for d in iq.LATE_DAYS)
    return {
        "ingest_snapshot": ingest_sql(),
        "dq_checks": dq_checks_sql(),
        "coerce_numeric": coerce_sql(),
        "scan_formats": w + fmts,
        "snapshot_day": w + f"SELECT {SEL}, snapshot_date FROM rows WHERE snapshot_date = DATE '{iq.SNAPSHOT_DAY}'",
        "recent_inference": w + f"SELECT {SEL}, strftime(snapshot_date, '%Y-%m-%d') AS _snapshot_date FROM rows "
                                f"WHERE snapshot_date BETWEEN DATE '{iq.RECENT_ANCHOR}' - INTERVAL 6 DAY "
                                f"AND DATE '{iq.RECENT_ANCHOR}'",
        "late_partitions": w + f"""SELECT CAST(g.d AS DATE) AS run_date, 'late' AS status
FROM generate_series(DATE '{iq.WINDOW_START}', DATE '{iq.WINDOW_END}', INTERVAL 1 DAY) AS g(d)
WHERE CAST(g.d AS DATE) NOT IN (SELECT DISTINCT snapshot_date FROM rows WHERE snapshot_date NOT IN ({late}))""",
        "training_dataset": w + f"SELECT {SEL}, strftime(snapshot_date, '%Y-%m-%d') AS _snapshot_date FROM rows "
                                f"WHERE snapshot_date BETWEEN DATE '{iq.WINDOW_END}' - INTERVAL 89 DAY "
                                f"AND DATE '{iq.WINDOW_END}'",
        "retrain_decisions": decisions_sql() + """
SELECT pipeline, run_date, overall_status, should_alert, should_retrain, n AS consecutive_count, n >= 3 AS retrain_requested,
       granted AS retrain_triggered, CASE WHEN granted THEN 0 ELSE n END AS counter_after FROM fold""",
        "model_registry": decisions_sql() + f"""
SELECT pipeline, 'v_' || strftime(run_date, '%Y%m%d') || '_' || id AS model_version, id AS run_id,
       strftime(run_date, '%Y-%m-%d') AS retrain_date, 'drift_threshold_breached' AS trigger_reason,
       n AS consecutive_drift_runs, 'retraining_trigger' AS dag_id, '{iq.REGISTRY_LOGGED_AT}' AS logged_at
FROM (SELECT *, left(sha1(pipeline || '|' || strftime(run_date, '%Y-%m-%d') || '|{iq.REGISTRY_LOGGED_AT}'), 10) AS id
      FROM fold WHERE granted)""",
    }
