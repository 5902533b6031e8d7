"""DuckDB twins of the documented-only capability queries."""

from __future__ import annotations

from driftline.plans import drift_queries, oracle_drift, oracle_ingest
from driftline.plans.oracle_drift import rnd
from driftline.plans.oracle_signals import long_sql, prediction_ctes, signal_ctes


def oracle_queries() -> dict[str, str]:
    roll = f"""WITH long AS (SELECT * FROM ({long_sql('warm')}) u WHERE x IS NOT NULL AND NOT isnan(x)),
seq AS (SELECT *, row_number() OVER (PARTITION BY model, feature ORDER BY ts, event_id) - 1 AS t FROM long),
w AS (
  SELECT model, feature, t, x,
         avg(x) OVER (PARTITION BY model, feature ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS m,
         stddev_samp(x) OVER (PARTITION BY model, feature ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS s,
         avg(x) OVER (PARTITION BY model, feature ORDER BY t ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS mp,
         stddev_samp(x) OVER (PARTITION BY model, feature ORDER BY t ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS sp,
         count(x) OVER (PARTITION BY model, feature ORDER BY t ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS np_
  FROM seq
),
z AS (SELECT *, CASE WHEN np_ >= 2 AND sp <> 0 THEN (x - mp) / sp END AS z FROM w)
SELECT model, feature, t, x, {rnd('m', 6)} AS rolling_mean, {rnd('s', 6)} AS rolling_std,
       {rnd('z', 4)} AS z_score, coalesce(abs(z) > 3.0, false) AS outlier FROM z"""
    cohesion = """WITH e AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings
),
c AS (SELECT label, dim, avg(v) AS cv FROM e GROUP BY label, dim),
d AS (
  SELECT e.vec_id, e.label, sum(e.v * c.cv) AS dot, sum(e.v * e.v) AS nv, sum(c.cv * c.cv) AS nc
  FROM e JOIN c ON c.label IS NOT DISTINCT FROM e.label AND c.dim = e.dim GROUP BY e.vec_id, e.label
)
SELECT label, count(*) AS n_vectors,
       """ + rnd("avg(CASE WHEN sqrt(nv) * sqrt(nc) = 0 THEN NULL ELSE dot / (sqrt(nv) * sqrt(nc)) END)", 6) + """ AS cohesion
FROM d GROUP BY label"""
    entropy = "WITH RECURSIVE " + signal_ctes("warm") + "," + prediction_ctes() + f""",
cnt AS (SELECT model, risk, count(*) AS c FROM pred GROUP BY model, risk),
tot AS (SELECT model, sum(c) AS n, count(*) AS levels FROM cnt GROUP BY model)
SELECT cnt.model, CAST(tot.n AS BIGINT) AS n_predictions, tot.levels AS n_levels,
       {rnd('-sum((CAST(c AS DOUBLE) / CAST(n AS DOUBLE)) * ln(CAST(c AS DOUBLE) / CAST(n AS DOUBLE)))', 6)} AS entropy
FROM cnt JOIN tot ON tot.model = cnt.model GROUP BY cnt.model, tot.n, tot.levels"""
    def nz(c):
        return f"CASE WHEN hi_{c} - lo_{c} = 0 THEN NULL ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END"
    cols = [("avg_drift", 0.5), ("avg_velocity", 0.3), ("avg_acceleration", 0.2)]
    num = " + ".join(f"coalesce(({nz(c)}) * CAST({w} AS DOUBLE), CAST(0.0 AS DOUBLE))" for c, w in cols)
    den = " + ".join(f"CASE WHEN ({nz(c)}) IS NOT NULL THEN CAST({w} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"
                     for c, w in cols)
    fusion = "WITH RECURSIVE " + signal_ctes("warm") + "," + prediction_ctes() + f""",
scored AS (SELECT * FROM pred WHERE avg_drift IS NOT NULL),
r AS (SELECT model, {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c, _ in cols)} FROM scored GROUP BY model),
j AS (SELECT s.*, {', '.join(f'r.lo_{c}, r.hi_{c}' for c, _ in cols)} FROM scored s JOIN r ON r.model = s.model)
SELECT event_id, model, {', '.join(rnd(nz(c), 6) + f' AS norm_{c[4:]}' for c, _ in cols)},
       {rnd(f"CASE WHEN ({den}) = 0 THEN NULL ELSE ({num}) / ({den}) END", 6)} AS fused_score
FROM j"""
    body = """replace(replace(message, '"', '\\"'), chr(10), '\\n')"""
    own = [oracle_drift.oracle_queries(drift_queries.RUN_DATE)["drift_alerts"], oracle_ingest.oracle_queries()["model_registry"]]
    head = """'{"attachments":[{"color":"' || color || '","text":"' || """ + body + """ || '","mrkdwn_in":["text"],"fields":['"""

    def fields(**shown: str) -> str:
        each = " || ',' || ".join(f"""'{{"title":"{t.replace('_', ' ')}","value":"' || {v} || '","short":true}}'""" for t, v in shown.items())
        return f"({head} || {each} || ']}}]}}')"

    payloads = f"""SELECT scenario, severity, {fields(Run_Date='run_date', DAG='dag_id', Drifted_Features='drifted_features',
                                                       Should_Retrain='should_retrain')} AS payload FROM ({own[0]}) a"""
    notices = f"""SELECT pipeline, model_version, retrain_date, 'ok' AS severity, message,
       {fields(Model_Version='model_version', Trigger_Date='retrain_date')} AS payload
FROM (SELECT *, '#36a64f' AS color, '✅ *ML Retraining Triggered* — `' || dag_id || '` | `' || retrain_date || '`' || chr(10)
             || 'New model version: *' || model_version || '*' || chr(10) || 'Drift counters reset. Monitoring continues.' AS message
      FROM ({own[1]}) r) m"""
    pairs = f"""WITH long AS (SELECT * FROM ({long_sql('steady')}) u WHERE x IS NOT NULL AND NOT isnan(x))
SELECT a.model, a.feature AS feature_a, b.feature AS feature_b, count(*) AS n, {rnd('corr(a.x, b.x)', 6)} AS correlation
FROM long a JOIN long b ON a.event_id = b.event_id AND a.feature < b.feature GROUP BY ALL"""
    return {"feature_correlation": pairs, "alert_payloads": payloads, "retrain_notices": notices, "rolling_stats": roll, "embedding_cohesion": cohesion, "risk_entropy": entropy,
            "signal_fusion": fusion}
