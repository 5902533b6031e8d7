"""Two-sample Kolmogorov-Smirnov p-values.

Two forms:

* ``kolmogorov_sf_expr`` - the limiting Kolmogorov distribution
  ``Q(l) = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 l^2)`` with ``l = sqrt(n) * D`` and
  ``n = round(n1 * n2 / (n1 + n2))``.  Pure SQL (``aggregate`` over a sequence), so it
  stays in the JVM and has a DuckDB twin.  The default.
* ``ks_pvalue`` - the probability for finite sizes: up to ``EXACT_ROWS`` rows on a side the
  exact two-sided one, by counting monotone lattice paths from (0, 0) to (n1, n2) that stay
  strictly inside the band ``|i/n1 - j/n2| < D``; beyond, the finite-n distribution by its
  expansion in 1/sqrt(n) (Pelz and Good), which is then good to seven decimals.  Both run on a
  handful of scalars per feature (sizes and D), never on the data, with bounded work.
"""

from __future__ import annotations

import math

import numpy as np

# The series is cut after 100 terms; below l = 0.2 the
# probability is 1 to double precision.
SERIES_TERMS = 100
SMALL_LAMBDA = 0.2


# Fixed value: most rows on a side for the exact probability.
EXACT_ROWS = 10_000


def kolmogorov_sf_expr(d: str, n1: str, n2: str) -> str:
    """Spark SQL text of the asymptotic two-sided p-value."""
    en = f"rint(CAST({n1} AS DOUBLE) * CAST({n2} AS DOUBLE) / (CAST({n1} AS DOUBLE) + CAST({n2} AS DOUBLE)))"
    lam = f"(sqrt({en}) * {d})"
    series = (f"(2.0 * aggregate(sequence(1, {SERIES_TERMS}), CAST(0.0 AS DOUBLE), "
              f"(acc, k) -> acc + (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) "
              f"* exp(-2.0 * CAST(k AS DOUBLE) * CAST(k AS DOUBLE) * {lam} * {lam})))")
    return (f"(CASE WHEN {d} IS NULL THEN NULL WHEN {lam} < {SMALL_LAMBDA} THEN 1.0 "
            f"ELSE least(greatest({series}, 0.0), 1.0) END)")


def ks_pvalue_asymp(d: float, n1: int, n2: int) -> float:
    en = float(np.rint(n1 * n2 / (n1 + n2)))
    lam = math.sqrt(en) * d
    if lam < SMALL_LAMBDA:
        return 1.0
    s = 0.0
    for k in range(1, SERIES_TERMS + 1):
        s += (1.0 if k % 2 == 1 else -1.0) * math.exp(-2.0 * k * k * lam * lam)
    return min(max(2.0 * s, 0.0), 1.0)


def ks_pvalue_exact(d: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value ``P(D >= d)`` under the null (no ties)."""
    if n1 <= 0 or n2 <= 0:
        return float("nan")
    g = math.gcd(n1, n2)
    a, b = n2 // g, n1 // g          # |i*a - j*b| is |i/n1 - j/n2| in units of 1/lcm
    lcm = (n1 // g) * n2
    h = int(np.rint(d * lcm))
    if h == 0:
        return 1.0
    # paths staying strictly inside |i*a - j*b| < h; row-wise prefix sums,
    # rescaled per row with the scale kept in logs
    log_scale = 0.0
    prev = np.zeros(n2 + 1)
    prev[0] = 1.0                    # virtual row before i = 0: the path starts at (0, 0)
    for i in range(n1 + 1):
        # j range with |i*a - j*b| < h
        lo = max(0, (i * a - h) // b + 1)
        hi = min(n2, -((-(i * a + h)) // b) - 1)
        row = np.zeros(n2 + 1)
        if lo <= hi:
            row[lo:hi + 1] = np.cumsum(prev[lo:hi + 1])
        m = row.max()
        if m == 0.0:
            return 1.0
        row /= m
        log_scale += math.log(m)
        prev = row
    inside_log = math.log(prev[n2]) + log_scale if prev[n2] > 0 else -math.inf
    log_total = math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1)
    p_inside = math.exp(inside_log - log_total) if inside_log > -math.inf else 0.0
    return min(max(1.0 - p_inside, 0.0), 1.0)


def kolmogorov_cdf(n: float, d: float) -> float:
    """P(D_n < d) of one sample of n, to the order n^(-3/2).

    The four terms are sums over half-integers h and integers k of polynomials in
    (pi h)^2 and z = sqrt(n) d, weighted by exp(-(pi h)^2 / (2 z^2))."""
    if d <= 0:
        return 0.0
    if d >= 1:
        return 1.0
    z = math.sqrt(n) * d
    if z * z > 18:
        return 1.0  # less than 1e-15 is left
    z2 = z * z
    z4, z6, z8 = z2 ** 2, z2 ** 3, z2 ** 4
    reach = int(3 * z + 4)
    h2 = (math.pi * (np.arange(reach) + 0.5)) ** 2
    k2 = (math.pi * np.arange(1, reach + 1)) ** 2
    wh, wk = 2 * np.exp(-h2 / (2 * z2)), 2 * np.exp(-k2 / (2 * z2))   # both signs
    root = math.sqrt(math.pi / 2)
    terms = [
        root / z * wh.sum(),
        root / (6 * z4) * ((h2 - z2) * wh).sum(),
        root / (72 * z ** 7) * ((6 * z6 + 2 * z4 + (2 * z4 - 5 * z2) * h2 + (1 - 2 * z2) * h2 ** 2) * wh).sum()
        - root / (36 * z ** 3) * (k2 * wk).sum(),
        root / (6480 * z ** 10) * (((5 - 30 * z2) * h2 ** 3 + (212 * z4 - 60 * z2) * h2 ** 2 + (135 * z4 - 96 * z6) * h2
                                    - 30 * z6 - 90 * z8) * wh).sum()
        + root / (108 * z6) * ((3 * z2 * k2 - k2 ** 2) * wk).sum()]
    return min(max(sum(t / n ** (i / 2) for i, t in enumerate(terms)), 0.0), 1.0)


def ks_pvalue(d: float, n1: int, n2: int) -> float:
    """Two-sided p-value for the given sizes."""
    if max(n1, n2) <= EXACT_ROWS:
        return ks_pvalue_exact(d, n1, n2)
    return 1.0 - kolmogorov_cdf(float(np.rint(n1 * n2 / (n1 + n2))), d)
