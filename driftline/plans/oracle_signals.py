"""DuckDB twins of the signal-engine queries: the recurrences run as recursive CTEs,
one step per event of each (model, feature) - the plain sequential loop."""

from __future__ import annotations

from driftline.plans.oracle_drift import rnd

def _d(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def long_sql(variant: str) -> str:
    k = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
    if variant == "warm":
        model = "CAST(user_id AS VARCHAR)"
        feats = [("f1", f"{_d(100.0)} + value / {_d(10.0)}"),
                 ("f2", f"{_d(100.0)} + {k} / {_d(10.0)}"),
                 ("f3", f"{_d(100.0)} + (value + {k}) / {_d(20.0)}")]
    elif variant == "flat":
        model = "event_type"
        feats = [("level", _d(7.3)), ("step", f"CASE WHEN ts < TIMESTAMP '2024-01-08' THEN {_d(100.0)} ELSE {_d(250.1)} END")]
    else:
        model = "event_type"
        feats = [("value", "value"), ("k", k), ("user_id", "CAST(user_id AS DOUBLE)")]
    parts = [f"SELECT event_id, {model} AS model, ts, {i} AS fpos, '{f}' AS feature, {e} AS x FROM events"
             for i, (f, e) in enumerate(feats)]
    return " UNION ALL ".join(parts)


def signal_ctes(variant: str, where: str = "") -> str:
    """CTE text (after WITH RECURSIVE) defining ``allrows`` with t, drift, velocity,
    acceleration, samples, baseline_mean, baseline_std for every row."""
    return f"""
long AS (SELECT * FROM ({long_sql(variant)}) u WHERE x IS NOT NULL AND NOT isnan(x) {where}),
seq AS (
  SELECT *, row_number() OVER (PARTITION BY model, feature ORDER BY ts, event_id) - 1 AS t FROM long
),
rec(model, feature, t, x0, m, s, d) AS (
  SELECT model, feature, t, x, x, greatest(abs(x) * {_d(0.1)}, {_d(0.01)}), CAST(NULL AS DOUBLE)
  FROM seq WHERE t = 0
  UNION ALL
  SELECT model, feature, t, x0, m1,
         {_d(0.01)} * CASE WHEN abs(x - m1) > level THEN abs(x - m1) ELSE 0 END + {_d(0.99)} * s,
         CASE WHEN dev <= level THEN {_d(0.0)} ELSE least(coalesce(dev / nullif(s, 0) / {_d(3.0)}, 1), {_d(1.0)}) END
  FROM (SELECT q.model, q.feature, q.t, q.x, r.x0, r.s, abs(q.x - r.m) AS dev,
               {_d(0.01)} * q.x + {_d(0.99)} * r.m AS m1, greatest(abs(q.x), abs(r.x0)) * {_d(1e-9)} AS level
        FROM rec r JOIN seq q ON q.model = r.model AND q.feature = r.feature AND q.t = r.t + 1) step
),
sd AS (
  SELECT q.event_id, q.model, q.ts, q.fpos, q.feature, q.x, q.t, r.m, r.s, r.d,
         max(CASE WHEN q.t = 1 THEN r.d END) OVER (PARTITION BY q.model, q.feature) AS d1,
         lag(r.d, 9) OVER (PARTITION BY q.model, q.feature ORDER BY q.t) AS d_lag
  FROM seq q JOIN rec r ON r.model = q.model AND r.feature = q.feature AND r.t = q.t
),
sv AS (
  SELECT *, CASE WHEN t >= 2 THEN (d - CASE WHEN t >= 10 THEN d_lag ELSE d1 END)
                                  / CAST(least(t, 10) - 1 AS DOUBLE) END AS v
  FROM sd
),
sv2 AS (
  SELECT *, max(CASE WHEN t = 2 THEN v END) OVER (PARTITION BY model, feature) AS v2,
            lag(v, 9) OVER (PARTITION BY model, feature ORDER BY t) AS v_lag
  FROM sv
),
sva AS (
  SELECT *, CASE WHEN t >= 3 THEN (v - CASE WHEN t >= 11 THEN v_lag ELSE v2 END)
                                  / CAST(least(t - 1, 10) - 1 AS DOUBLE) END AS a
  FROM sv2
),
rec2(model, feature, t, e, ev, ea) AS (
  SELECT model, feature, t, d, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM sva WHERE t = 1
  UNION ALL
  SELECT q.model, q.feature, q.t,
         {_d(0.1)} * q.d + {_d(0.9)} * r.e,
         CASE WHEN q.t = 2 THEN q.v ELSE {_d(0.1)} * q.v + {_d(0.9)} * r.ev END,
         CASE WHEN q.t < 3 THEN NULL WHEN q.t = 3 THEN q.a ELSE {_d(0.1)} * q.a + {_d(0.9)} * r.ea END
  FROM rec2 r JOIN sva q ON q.model = r.model AND q.feature = r.feature AND q.t = r.t + 1
),
allrows AS (
  SELECT s.event_id, s.model, s.ts, s.fpos, s.feature, s.x, s.t, s.m AS baseline_mean, s.s AS baseline_std,
         CASE WHEN s.t >= 1 THEN {rnd("r.e", 4)} END AS drift,
         CASE WHEN s.t >= 2 THEN {rnd("r.ev", 6)} WHEN s.t = 1 THEN {_d(0.0)} END AS velocity,
         CASE WHEN s.t >= 3 THEN {rnd("r.ea", 6)} WHEN s.t >= 1 THEN {_d(0.0)} END AS acceleration,
         least(s.t, 100) AS samples
  FROM sva s LEFT JOIN rec2 r ON r.model = s.model AND r.feature = s.feature AND r.t = s.t
)"""


def _fold(arr: str) -> str:
    """Sum in list order."""
    return f"list_reduce({arr}, lambda s, x: s + x, {_d(0.0)})"


def prediction_ctes() -> str:
    return f"""
per AS (
  SELECT event_id, model, max(ts) AS ts,
         coalesce(list(drift ORDER BY fpos) FILTER (WHERE t >= 1), []) AS ds,
         coalesce(list(velocity ORDER BY fpos) FILTER (WHERE t >= 1 AND velocity <> 0), []) AS vs,
         coalesce(list(acceleration ORDER BY fpos) FILTER (WHERE t >= 1 AND acceleration <> 0), []) AS as_,
         coalesce(list(CAST(samples AS DOUBLE) ORDER BY fpos) FILTER (WHERE t >= 1), []) AS ss
  FROM allrows GROUP BY event_id, model
),
means AS (
  SELECT event_id, model, ts, len(ds) AS n_features,
         {_fold("ds")} / CAST(len(ds) AS DOUBLE) AS d,
         CASE WHEN len(vs) > 0 THEN {_fold("vs")} / CAST(len(vs) AS DOUBLE) ELSE {_d(0.0)} END AS v,
         CASE WHEN len(as_) > 0 THEN {_fold("as_")} / CAST(len(as_) AS DOUBLE) ELSE {_d(0.0)} END AS a,
         {_fold("ss")} / CAST(len(ds) AS DOUBLE) AS avg_samples
  FROM per
),
quad AS (
  SELECT *, v * v - {_d(4.0)} * ({_d(0.5)} * a) * (d - {_d(0.25)}) AS disc FROM means
),
pred AS (
  SELECT event_id, model, ts, n_features,
    CASE WHEN n_features = 0 THEN 'UNKNOWN'
         WHEN d > {_d(0.4)} OR a > {_d(0.001)} THEN 'CRITICAL'
         WHEN d > {_d(0.25)} OR v > {_d(0.01)} THEN 'HIGH'
         WHEN d > {_d(0.15)} THEN 'MEDIUM' ELSE 'LOW' END AS risk,
    CASE WHEN n_features = 0 THEN NULL
         WHEN d >= {_d(0.25)} THEN CAST(0 AS BIGINT)
         WHEN v <= 0 AND a <= 0 THEN NULL
         WHEN v > 0 THEN greatest(1, CAST(trunc(({_d(0.25)} - d) / v * {_d(60.0)}) AS BIGINT))
         WHEN a > 0 AND disc >= 0 AND (-v + sqrt(disc)) / ({_d(2.0)} * ({_d(0.5)} * a)) > 0
           THEN greatest(1, CAST(trunc((-v + sqrt(disc)) / ({_d(2.0)} * ({_d(0.5)} * a)) * {_d(60.0)}) AS BIGINT))
         ELSE NULL END AS time_to_failure,
    CASE WHEN n_features = 0 THEN 'LOW'
         WHEN avg_samples < 10 OR n_features < 2 THEN 'LOW'
         WHEN avg_samples < 50 OR n_features < 3 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence,
    CASE WHEN n_features = 0 THEN 'EARLY_WARNING'
         WHEN {rnd("a", 6)} > {_d(0.002)} THEN 'DATA'
         WHEN {rnd("v", 6)} > {_d(0.02)} THEN 'MODEL'
         WHEN {rnd("d", 4)} > {_d(0.25)} THEN 'DATA' ELSE 'EARLY_WARNING' END AS root_cause,
    CASE WHEN n_features > 0 THEN {rnd("d", 4)} END AS avg_drift,
    CASE WHEN n_features > 0 THEN {rnd("v", 6)} END AS avg_velocity,
    CASE WHEN n_features > 0 THEN {rnd("a", 6)} END AS avg_acceleration,
    CASE WHEN n_features = 0 THEN 'initializing'
         WHEN d >= {_d(0.25)} THEN 'zero' WHEN v <= 0 AND a <= 0 THEN 'none'
         WHEN v > 0 THEN 'linear' ELSE 'quadratic' END AS ttf_branch
  FROM quad
)"""


def oracle_queries() -> dict[str, str]:
    warm = "WITH RECURSIVE " + signal_ctes("warm")
    steady = "WITH RECURSIVE " + signal_ctes("steady")
    sig_cols = "event_id, model, feature, drift, velocity, acceleration, samples, ts"
    pred_cols = ("event_id, model, risk, time_to_failure, confidence, root_cause, avg_drift, avg_velocity, "
                 "avg_acceleration, ts")
    wp = warm + "," + prediction_ctes()
    sp = steady + "," + prediction_ctes()
    k = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
    return {
        "parse_events": f"SELECT event_id, CAST(user_id AS VARCHAR) AS model, ts, "
                        f"{_d(100.0)} + value / {_d(10.0)} AS f1, {_d(100.0)} + {k} / {_d(10.0)} AS f2, "
                        f"{_d(100.0)} + (value + {k}) / {_d(20.0)} AS f3, value AS prediction, true AS valid "
                        f"FROM events",
        "explode_features": f"SELECT event_id, model, ts, fpos, feature, x FROM ({long_sql('warm')}) u "
                            f"WHERE x IS NOT NULL AND NOT isnan(x)",
        "baseline_ema": f"{steady} SELECT event_id, model, feature, t, {rnd('baseline_mean', 6)} AS baseline_mean, "
                        f"{rnd('baseline_std', 6)} AS baseline_std FROM allrows",
        "signals": f"{warm} SELECT {sig_cols} FROM allrows WHERE t >= 1",
        "signals_steady": f"{steady} SELECT {sig_cols} FROM allrows WHERE t >= 1",
        "signals_flat": f"WITH RECURSIVE {signal_ctes('flat')} SELECT {sig_cols} FROM allrows WHERE t >= 1",
        "model_state": f"""{warm},
last AS (
  SELECT model, feature, drift, velocity, acceleration, samples FROM (
    SELECT *, row_number() OVER (PARTITION BY model, feature ORDER BY ts DESC, event_id DESC) AS rn FROM allrows
  ) WHERE rn = 1
)
SELECT model, feature, coalesce(drift, {_d(0.0)}) AS drift, coalesce(velocity, {_d(0.0)}) AS velocity,
       coalesce(acceleration, {_d(0.0)}) AS acceleration, CAST(samples AS BIGINT) AS samples,
       true AS initialized, count(*) OVER (PARTITION BY model) AS feature_count
FROM last""",
        "model_prediction": f"{wp} SELECT {pred_cols} FROM pred",
        "time_to_failure": f"{wp} SELECT event_id, model, avg_drift, avg_velocity, avg_acceleration, "
                           f"time_to_failure, ttf_branch FROM pred",
        "prediction_steady": f"{sp} SELECT {pred_cols} FROM pred",
        "signals_recent": f"{warm} SELECT {sig_cols} FROM allrows WHERE t >= 1 "
                          f"ORDER BY ts DESC, event_id DESC, feature DESC LIMIT 100",
        "signals_recent_model": f"{warm} SELECT {sig_cols} FROM allrows WHERE t >= 1 AND model = '7' "
                                f"ORDER BY ts DESC, event_id DESC, feature DESC LIMIT 100",
        "events_recent": "SELECT event_id, CAST(user_id AS VARCHAR) AS model, ts, 3 AS n_features, value AS prediction "
                         "FROM events ORDER BY ts DESC, event_id DESC LIMIT 100",
        "prediction_history": f"{wp} SELECT event_id, model, risk, time_to_failure, confidence, root_cause, ts "
                              f"FROM pred WHERE model = '42' ORDER BY ts DESC, event_id DESC LIMIT 100",
        "latest_prediction": f"{wp} SELECT event_id, model, risk, time_to_failure, confidence, root_cause, ts "
                             f"FROM pred ORDER BY ts DESC, event_id DESC LIMIT 1",
        "latest_of_model": f"""{wp}
(SELECT event_id, model, risk, time_to_failure, confidence, root_cause, ts FROM pred WHERE model = '42'
 ORDER BY ts DESC, event_id DESC LIMIT 1)
UNION ALL SELECT CAST(NULL AS BIGINT), 'no such model', 'LOW', CAST(NULL AS BIGINT), 'LOW', 'NONE', CAST(NULL AS TIMESTAMP)""",
        "latest_predictions": f"""{wp},
lastp AS (
  SELECT model, arg_max(struct_pack(event_id := event_id, risk := risk, time_to_failure := time_to_failure,
                        confidence := confidence, root_cause := root_cause, ts := ts),
                        struct_pack(ts := ts, event_id := event_id)) AS p
  FROM pred GROUP BY model
)
SELECT p.event_id AS event_id, model, p.risk AS risk, p.time_to_failure AS time_to_failure,
       p.confidence AS confidence, p.root_cause AS root_cause, p.ts AS ts FROM lastp
UNION ALL
SELECT CAST(NULL AS BIGINT), 'unknown', 'LOW', CAST(NULL AS BIGINT), 'LOW', 'NONE', CAST(NULL AS TIMESTAMP)
WHERE NOT EXISTS (SELECT 1 FROM pred)""",
        "recent_trajectory": f"""{wp}
SELECT model, point, event_id, ts, risk, avg_drift, avg_velocity, avg_acceleration FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY ts DESC, event_id DESC) AS INTEGER) AS point FROM pred
) WHERE point <= 51""",
        "active_models": "SELECT DISTINCT model FROM (SELECT CAST(user_id AS VARCHAR) AS model FROM events "
                         "ORDER BY ts DESC, event_id DESC LIMIT 1000)",
        "pipeline_metrics": f"""{wp}
SELECT (SELECT count(*) FROM events) AS events_processed,
       (SELECT count(*) FROM allrows WHERE t >= 1) AS signals_computed,
       (SELECT count(*) FROM pred) AS predictions_generated""",
    }


def stream_oracles() -> dict[str, str]:
    """Queries of the intake and of late events."""
    good = "WITH RECURSIVE " + signal_ctes("warm", "AND event_id % 50 NOT IN (7, 17, 27, 37, 47)") + "," + prediction_ctes()
    return {
        "late_events": f"""WITH long AS ({long_sql('warm')}),
newest AS (SELECT model, feature, max(ts) AS ts FROM long WHERE event_id % 10 <> 3 GROUP BY ALL)
SELECT l.event_id, l.model, l.feature, l.ts FROM long l JOIN newest n ON n.model = l.model AND n.feature = l.feature
WHERE l.event_id % 10 = 3 AND l.ts < n.ts - INTERVAL 1 HOUR""",
        "intake_predictions": f"""{good}
SELECT event_id, model, risk, confidence, root_cause, n_features::INTEGER AS n_features FROM pred
UNION ALL SELECT event_id, CAST(user_id AS VARCHAR), 'UNKNOWN', 'LOW', 'EARLY_WARNING', 0 FROM events WHERE event_id % 50 = 47""",
        "intake_tables": """SELECT CASE WHEN event_id % 50 IN (7, 17, 27, 37) THEN 'rejects' ELSE 'events' END AS name,
       CASE event_id % 50 WHEN 7 THEN 'not a JSON object' WHEN 17 THEN 'no model' WHEN 27 THEN 'no features'
            WHEN 37 THEN 'a feature is not a number' END AS reason,
       count(*) AS rows, sum(CASE WHEN event_id % 50 IN (7, 17, 27, 37, 47) THEN 0 ELSE 3 END)::BIGINT AS features
FROM events GROUP BY ALL"""}
