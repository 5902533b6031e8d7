import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.functions.kolmogorov import kolmogorov_cdf, ks_pvalue, ks_pvalue_asymp, ks_pvalue_exact
from driftline.functions.numeric import round_half_even


def test_round_half_even_matches_numpy(spark):
    vals = [0.12345, 0.30555, 1.00005, -0.123456789, 2.5e-5, 0.6583335]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(round_half_even("v", 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in vals]


def _brute_ks_p(n1, n2, d_obs):
    """P(D >= d_obs) by enumerating every split of n1 + n2 ranks."""
    total = 0
    hits = 0
    for comb in itertools.combinations(range(n1 + n2), n1):
        s = set(comb)
        i = j = 0
        dmax = 0.0
        for k in range(n1 + n2):
            if k in s:
                i += 1
            else:
                j += 1
            dmax = max(dmax, abs(i / n1 - j / n2))
        total += 1
        hits += dmax >= d_obs - 1e-12
    return hits / total


@pytest.mark.parametrize("n1,n2,d", [(4, 4, 0.5), (5, 3, 0.6), (6, 4, 0.5), (3, 7, 1 / 3), (5, 5, 0.8)])
def test_ks_exact_against_enumeration(n1, n2, d):
    assert ks_pvalue_exact(d, n1, n2) == pytest.approx(_brute_ks_p(n1, n2, d), abs=1e-12)


def test_ks_exact_close_to_asymptotic_for_large_samples():
    p_exact = ks_pvalue_exact(0.02, 4000, 4000)
    p_asym = ks_pvalue_asymp(0.02, 4000, 4000)
    assert abs(p_exact - p_asym) < 0.01
    assert ks_pvalue_asymp(0.0, 100, 100) == 1.0
    assert 0.0 <= ks_pvalue_asymp(0.5, 100, 100) < 1e-5
    assert math.isclose(ks_pvalue_exact(0.0, 10, 12), 1.0)


def _one_sample_cdf(n, d):
    """P(D_n < d) by the power of a banded matrix (exact; small n only)."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    H = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        H[i, 0] -= h ** (i + 1)
        H[m - 1, i] -= h ** (m - i)
    H[m - 1, 0] += max(2 * h - 1, 0) ** m
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                H[i, j] /= math.factorial(i - j + 1)
    power, out = H, np.eye(m)
    scale = 0
    for _ in range(n):
        out = out @ power
        if out[k - 1, k - 1] > 1e140:
            out, scale = out * 1e-140, scale + 140
    q = out[k - 1, k - 1]
    return math.exp(math.log(q) + scale * math.log(10) + math.lgamma(n + 1) - n * math.log(n))


def test_finite_n_distribution():
    assert ks_pvalue(0.25, 60, 40) == pytest.approx(0.0883, abs=5e-5)
    for n in (400, 600):
        for d in (0.03, 0.05, 0.07, 0.09, 0.11):
            assert kolmogorov_cdf(n, d) == pytest.approx(_one_sample_cdf(n, d), abs=2e-6)
    # beyond the exact rows: close to the exact probability and bounded
    assert abs(ks_pvalue(0.03, 10_001, 4000) - ks_pvalue_exact(0.03, 10_001, 4000)) < 1e-3
    assert ks_pvalue(0.0, 10**9, 10**9) == 1.0 and 0 <= ks_pvalue(0.9, 10**9, 10**9) < 1e-12
