"""Threshold configuration (a plain dict parameter, shallow-merged over defaults)."""

from __future__ import annotations

import copy

# Default drift thresholds.
DEFAULT_THRESHOLDS = {
    "psi": {"warning": 0.1, "critical": 0.2},
    "ks_p_value": 0.05,
    "mean_shift_pct": 10.0,
    "var_shift_pct": 20.0,
    "consecutive_runs_before_retrain": 3,
    "retrain_allowed_hours": {"start": 8, "end": 18},
}


def thresholds(user: dict | None = None) -> dict:
    """Shallow merge: a user ``psi`` block replaces the whole default block."""
    merged = copy.deepcopy(DEFAULT_THRESHOLDS)
    merged.update(user or {})
    return merged
