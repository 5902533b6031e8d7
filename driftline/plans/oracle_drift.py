"""DuckDB SQL twins of the batch-drift queries (correctness oracle)."""

from __future__ import annotations

from driftline.sources.tables import BASELINE_END, DRIFT_FEATURES, DRIFT_SCENARIOS

D = "CAST({} AS DOUBLE)"


def rnd(expr: str, digits: int) -> str:
    s = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(round_even(({expr}) * {s}, 0) / {s})"


def comparable(column: str, digits: int = 10) -> str:
    """Six decimals, compared to ``digits`` significant digits."""
    x = rnd(column, 6)
    scale = f"pow(CAST(10.0 AS DOUBLE), {digits - 1} - CAST(floor(log10(abs({x}))) AS BIGINT))"
    return f"(CASE WHEN {x} = 0 OR {x} IS NULL THEN {x} ELSE round_even({x} * {scale}, 0) / {scale} END)"


def fold(terms: str) -> str:
    """Sum in list order."""
    return f"list_reduce(list_transform({terms}, lambda p: p.term), lambda s, x: s + x, CAST(0.0 AS DOUBLE))"


def _scenario_rows() -> str:
    vals = ", ".join(f"('{s}')" for s in DRIFT_SCENARIOS)
    conds = []
    for s, c in DRIFT_SCENARIOS.items():
        conds.append(f"(sc.scenario = '{s}'" + (f" AND ({c}))" if c else ")"))
    return vals, " OR ".join(conds)


def base_ctes(buckets: int = 10, tagged_sql: str | None = None, features: list[str] | None = None,
              warning: float = 0.1, critical: float = 0.2, shift: float | None = None) -> str:
    vals, conds = _scenario_rows()
    base = f"l_shipdate < TIMESTAMP '{BASELINE_END}'"
    if tagged_sql is None:
        tagged_sql = f"""SELECT sc.scenario, CASE WHEN {base} THEN 'b' ELSE 'c' END AS side, li.*
  FROM lineitem li CROSS JOIN (VALUES {vals}) AS sc(scenario)
  WHERE ({base}) OR ({conds})"""
    unions = " UNION ALL ".join(
        f"SELECT scenario, side, {i} AS feature_idx, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM tagged"
        for i, f in enumerate(features or DRIFT_FEATURES))
    step = 100.0 / buckets
    return f"""
tagged AS (
  {tagged_sql}
),
long AS (
  SELECT * FROM ({unions}) u WHERE value IS NOT NULL AND NOT isnan(value)
),
totals AS (
  SELECT scenario, feature_idx, feature,
         count(*) FILTER (WHERE side = 'b') AS n_baseline,
         count(*) FILTER (WHERE side = 'c') AS n_current
  FROM long GROUP BY scenario, feature_idx, feature
),
ranked_b AS (
  SELECT scenario, feature_idx, feature, value,
         row_number() OVER (PARTITION BY scenario, feature_idx, feature ORDER BY value) - 1 AS rnk
  FROM long WHERE side = 'b'
),
targets AS (
  SELECT t.scenario, t.feature_idx, t.feature, t.n_baseline, k.k,
         CAST(t.n_baseline - 1 AS DOUBLE) *
           ((CASE WHEN k.k = {buckets} THEN CAST(100.0 AS DOUBLE)
                  ELSE CAST(k.k AS DOUBLE) * CAST({step!r} AS DOUBLE) END) / CAST(100.0 AS DOUBLE)) AS vi
  FROM totals t CROSS JOIN range(0, {buckets + 1}) AS k(k)
  WHERE t.n_baseline > 0
),
targets2 AS (
  SELECT *, CAST(floor(vi) AS BIGINT) AS lo,
         least(CAST(floor(vi) AS BIGINT) + 1, n_baseline - 1) AS hi,
         vi - floor(vi) AS frac
  FROM targets
),
edge_pts AS (
  SELECT t.scenario, t.feature_idx, t.feature, t.k, t.frac, a.value AS a, b.value AS b
  FROM targets2 t
  JOIN ranked_b a ON a.scenario = t.scenario AND a.feature = t.feature AND a.rnk = t.lo
  JOIN ranked_b b ON b.scenario = t.scenario AND b.feature = t.feature AND b.rnk = t.hi
),
edges AS (
  SELECT scenario, feature_idx, feature,
         list_sort(list_distinct(list(CASE WHEN frac >= 0.5 THEN b - (b - a) * (CAST(1.0 AS DOUBLE) - frac)
                                            ELSE a + (b - a) * frac END))) AS edges
  FROM edge_pts GROUP BY scenario, feature_idx, feature
),
binned AS (
  SELECT l.scenario, l.feature_idx, l.feature, l.side,
         CASE WHEN l.value = e.edges[len(e.edges)] THEN len(e.edges) - 2
              ELSE len(list_filter(e.edges, lambda x: x <= l.value)) - 1 END AS bin
  FROM long l JOIN edges e ON e.scenario = l.scenario AND e.feature = l.feature
  WHERE len(e.edges) >= 2 AND l.value >= e.edges[1] AND l.value <= e.edges[len(e.edges)]
),
bin_counts AS (
  SELECT scenario, feature_idx, feature, bin,
         count(*) FILTER (WHERE side = 'b') AS cnt_b, count(*) FILTER (WHERE side = 'c') AS cnt_c
  FROM binned GROUP BY ALL
),
all_bins AS (
  SELECT e.scenario, e.feature_idx, e.feature, e.edges, g.bin
  FROM edges e CROSS JOIN range(0, {buckets}) AS g(bin)
  WHERE g.bin <= len(e.edges) - 2
),
psi_bins AS (
  SELECT a.scenario, a.feature_idx, a.feature, CAST(a.bin AS INTEGER) AS bin,
         a.edges[a.bin + 1] AS lower, a.edges[a.bin + 2] AS upper,
         coalesce(c.cnt_b, 0) AS count_baseline, coalesce(c.cnt_c, 0) AS count_current,
         CAST(coalesce(c.cnt_b, 0) AS DOUBLE) / CAST(t.n_baseline AS DOUBLE) + CAST(0.0001 AS DOUBLE) AS pct_baseline,
         CAST(coalesce(c.cnt_c, 0) AS DOUBLE) / CAST(t.n_current AS DOUBLE) + CAST(0.0001 AS DOUBLE) AS pct_current
  FROM all_bins a
  LEFT JOIN bin_counts c ON c.scenario = a.scenario AND c.feature = a.feature AND c.bin = a.bin
  JOIN totals t ON t.scenario = a.scenario AND t.feature = a.feature
),
psi_terms AS (
  SELECT scenario, feature_idx, feature,
         list_sort(list(struct_pack(bin := bin, term := (pct_current - pct_baseline) * ln(pct_current / pct_baseline)))) AS terms
  FROM psi_bins GROUP BY ALL
),
psi AS (
  SELECT t.scenario, t.feature_idx, t.feature,
         CASE WHEN t.n_baseline = 0 OR t.n_current = 0 THEN NULL
              ELSE coalesce({fold("p.terms")}, CAST(0.0 AS DOUBLE)) END AS psi_raw
  FROM totals t LEFT JOIN psi_terms p ON p.scenario = t.scenario AND p.feature = t.feature
),
psi_out AS (
  SELECT scenario, feature_idx, feature, {rnd("psi_raw", 6)} AS psi,
         CASE WHEN psi_raw IS NULL THEN 'insufficient_data' WHEN psi_raw < {warning} THEN 'ok'
              WHEN psi_raw < {critical} THEN 'warning' ELSE 'critical' END AS severity
  FROM psi
),
vcounts AS (
  SELECT scenario, feature_idx, feature, value,
         count(*) FILTER (WHERE side = 'b') AS n_b, count(*) FILTER (WHERE side = 'c') AS n_c
  FROM long GROUP BY ALL
),
ecdf AS (
  SELECT *, sum(n_b) OVER w AS cum_b, sum(n_c) OVER w AS cum_c
  FROM vcounts WINDOW w AS (PARTITION BY scenario, feature_idx, feature ORDER BY value
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
ks_d AS (
  SELECT e.scenario, e.feature_idx, e.feature,
         max(abs(CAST(e.cum_b AS DOUBLE) / CAST(t.n_baseline AS DOUBLE) - CAST(e.cum_c AS DOUBLE) / CAST(t.n_current AS DOUBLE))) AS d_raw
  FROM ecdf e JOIN totals t ON t.scenario = e.scenario AND t.feature = e.feature
  WHERE t.n_baseline > 0 AND t.n_current > 0
  GROUP BY ALL
),
ks_p AS (
  SELECT t.scenario, t.feature_idx, t.feature, d.d_raw,
         sqrt(round_even(CAST(t.n_baseline AS DOUBLE) * CAST(t.n_current AS DOUBLE)
              / (CAST(t.n_baseline AS DOUBLE) + CAST(t.n_current AS DOUBLE)), 0)) * d.d_raw AS lam
  FROM totals t LEFT JOIN ks_d d ON d.scenario = t.scenario AND d.feature = t.feature
),
ks_out AS (
  SELECT scenario, feature_idx, feature, {rnd("d_raw", 6)} AS ks_statistic,
         {rnd('''CASE WHEN d_raw IS NULL THEN NULL WHEN lam < 0.2 THEN CAST(1.0 AS DOUBLE)
              ELSE least(greatest(CAST(2.0 AS DOUBLE) * list_reduce(list_transform(range(1, 101),
                   lambda k: (CASE WHEN k % 2 = 1 THEN CAST(1.0 AS DOUBLE) ELSE CAST(-1.0 AS DOUBLE) END)
                   * exp(CAST(-2.0 AS DOUBLE) * CAST(k AS DOUBLE) * CAST(k AS DOUBLE) * lam * lam)),
                   lambda a, b: a + b), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) END''', 6)} AS p_value
  FROM ks_p
),
ks_final AS (
  SELECT *, coalesce(p_value < 0.05, false) AS drifted FROM ks_out
),
shift_raw AS (
  SELECT scenario, feature_idx, feature,
         avg(value) FILTER (WHERE side = 'b') AS bm, avg(value) FILTER (WHERE side = 'c') AS cm,
         var_samp(value) FILTER (WHERE side = 'b') AS bv, var_samp(value) FILTER (WHERE side = 'c') AS cv
  FROM long GROUP BY ALL
),
shift_out AS (
  SELECT scenario, feature_idx, feature,
         {comparable("bm")} AS baseline_mean, {comparable("cm")} AS current_mean,
         {rnd("abs(cm - bm) / (abs(bm) + CAST(1e-9 AS DOUBLE)) * CAST(100.0 AS DOUBLE)", 2)} AS mean_shift_pct,
         {comparable("bv")} AS baseline_var, {comparable("cv")} AS current_var,
         {rnd("abs(cv - bv) / (abs(bv) + CAST(1e-9 AS DOUBLE)) * CAST(100.0 AS DOUBLE)", 2)} AS var_shift_pct
  FROM shift_raw
),
ranks AS (
  SELECT scenario, feature_idx, feature, CASE severity WHEN 'warning' THEN 1 WHEN 'critical' THEN 2 ELSE 0 END AS rank FROM psi_out
  UNION ALL SELECT scenario, feature_idx, feature, CASE WHEN drifted THEN 1 ELSE 0 END FROM ks_final
  UNION ALL SELECT scenario, feature_idx, feature,
         CASE WHEN coalesce(mean_shift_pct > {shift or 10.0}, false) OR coalesce(var_shift_pct > {shift or 20.0}, false) THEN 1 ELSE 0 END
  FROM shift_out
),
verdicts AS (
  SELECT scenario, feature_idx, feature, max(rank) AS rank,
         CASE max(rank) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'ok' END AS status
  FROM ranks GROUP BY ALL
),
overall AS (
  SELECT scenario, CASE max(rank) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'ok' END AS overall_status,
         max(rank) >= 1 AS should_alert, max(rank) >= 2 AS should_retrain,
         count(*) FILTER (WHERE rank > 0) AS n_drifted, count(*) AS n_features
  FROM verdicts GROUP BY scenario
),
overall_out AS (
  SELECT *, 'Drift evaluation complete. Status=' || overall_status || '. ' || n_drifted || '/' || n_features
            || ' features drifted.' AS summary
  FROM overall
)"""


def oracle_queries(run_date: str, dag_id: str = "drift_monitoring") -> dict[str, str]:
    w = "WITH " + base_ctes()
    nd, nb, ns = "CAST(NULL AS DOUBLE)", "CAST(NULL AS BOOLEAN)", "CAST(NULL AS VARCHAR)"
    report = f"""{w}
SELECT scenario, feature_idx, feature, '{run_date}' AS run_date, '{dag_id}' AS dag_id, 'psi' AS section,
       psi, severity, {nd} AS ks_statistic, {nd} AS p_value, {nb} AS drifted, {nd} AS baseline_mean,
       {nd} AS current_mean, {nd} AS mean_shift_pct, {nd} AS baseline_var, {nd} AS current_var, {nd} AS var_shift_pct
FROM psi_out
UNION ALL
SELECT scenario, feature_idx, feature, '{run_date}', '{dag_id}', 'ks', {nd}, {ns}, ks_statistic, p_value, drifted,
       {nd}, {nd}, {nd}, {nd}, {nd}, {nd} FROM ks_final
UNION ALL
SELECT scenario, feature_idx, feature, '{run_date}', '{dag_id}', 'shift', {nd}, {ns}, {nd}, {nd}, {nb},
       baseline_mean, current_mean, mean_shift_pct, baseline_var, current_var, var_shift_pct FROM shift_out"""
    alerts = f"""{w},
drifted AS (
  SELECT scenario, string_agg(feature, ', ' ORDER BY feature_idx) AS lst FROM verdicts WHERE status <> 'ok' GROUP BY scenario
)
SELECT o.scenario, '{run_date}' AS run_date, '{dag_id}' AS dag_id, o.overall_status AS severity,
       CASE o.overall_status WHEN 'ok' THEN '#36a64f' WHEN 'warning' THEN '#ffcc00' WHEN 'critical' THEN '#ff0000'
            ELSE '#ffcc00' END AS color,
       (CASE o.overall_status WHEN 'ok' THEN '✅' WHEN 'warning' THEN '⚠️' WHEN 'critical' THEN '\U0001f6a8' ELSE '❓' END)
         || ' *ML Drift Alert* — `{dag_id}` | `{run_date}`' || chr(10) || 'Status: *' || upper(o.overall_status) || '*'
         || chr(10) || o.summary AS message,
       coalesce(nullif(d.lst, ''), 'none') AS drifted_features,
       CASE WHEN o.should_retrain THEN 'Yes' ELSE 'No' END AS should_retrain
FROM overall_out o LEFT JOIN drifted d ON d.scenario = o.scenario
WHERE o.should_alert"""
    return {
        "drift_features": f"{w} SELECT scenario, feature_idx, feature, n_baseline, n_current FROM totals",
        "psi_edges": f"{w} SELECT scenario, feature_idx, feature, CAST(i - 1 AS INTEGER) AS edge_idx, edges[i] AS edge "
                     f"FROM edges CROSS JOIN range(1, 12) AS r(i) WHERE i <= len(edges)",
        "psi_bins": f"{w} SELECT * FROM psi_bins",
        "drift_psi": f"{w} SELECT * FROM psi_out",
        "drift_ks": f"{w} SELECT * FROM ks_final",
        "drift_shift": f"{w} SELECT * FROM shift_out",
        "feature_verdicts": f"{w} SELECT scenario, feature_idx, feature, status FROM verdicts",
        "drift_verdict": f"{w} SELECT * FROM overall_out",
        "drift_report": report,
        "drift_alerts": alerts,
        "drift_kl": f"""{w},
kl_terms AS (
  SELECT scenario, feature_idx, feature,
         list_sort(list(struct_pack(bin := bin, term := pct_baseline * ln(pct_baseline / pct_current)))) AS terms
  FROM psi_bins GROUP BY ALL
)
SELECT t.scenario, t.feature_idx, t.feature,
       {rnd(f"CASE WHEN t.n_baseline = 0 OR t.n_current = 0 THEN NULL ELSE coalesce({fold("k.terms")}, CAST(0.0 AS DOUBLE)) END", 6)} AS kl
FROM totals t LEFT JOIN kl_terms k ON k.scenario = t.scenario AND k.feature = t.feature""",
        "segment_psi": "WITH " + base_ctes(tagged_sql=f"""SELECT l_returnflag AS scenario,
    CASE WHEN l_shipdate < TIMESTAMP '{BASELINE_END}' THEN 'b' ELSE 'c' END AS side, li.* FROM lineitem li""")
        + " SELECT scenario AS segment, feature_idx, feature, psi, severity FROM psi_out",
    }
