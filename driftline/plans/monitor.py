"""Drift monitoring job: baseline + recent data -> metrics -> verdicts -> alerts.

Tagged union -> unpivot -> ECDF (one shuffle on (segment, feature, value), pinned ranges,
the baseline ranked once for all segments) -> PSI / KS / shift ->
verdicts.  Branching (alert, retrain) is a filter on the verdict rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from driftline.config import thresholds as merge_thresholds
from driftline.operators.drift import DriftTables, feature_columns, tag_sides
from driftline.operators.verdict import (drift_alerts, drift_report, feature_verdicts,
                                         overall_verdict)

DAG_ID = "drift_monitoring"


@dataclass
class DriftResult:
    """The outputs of one run, each built when it is first read."""

    tables: DriftTables
    limits: dict
    p_value_method: str

    @cached_property
    def psi(self) -> DataFrame:
        return self.tables.psi(self.limits["psi"]["warning"], self.limits["psi"]["critical"])

    @cached_property
    def ks(self) -> DataFrame:
        return self.tables.ks(self.limits["ks_p_value"], self.p_value_method)

    @cached_property
    def shift(self) -> DataFrame:
        return self.tables.shift(once=True)

    @cached_property
    def verdicts(self) -> DataFrame:
        return feature_verdicts(self.psi, self.ks, self.shift, self.tables.keys, self.limits)

    @cached_property
    def overall(self) -> DataFrame:
        return overall_verdict(self.verdicts, self.tables.segments)

    def report(self, run_date: str, dag_id: str = DAG_ID) -> DataFrame:
        return drift_report(self.psi, self.ks, self.shift, self.tables.keys, run_date, dag_id)

    def alerts(self, run_date: str, dag_id: str = DAG_ID) -> DataFrame:
        return drift_alerts(self.verdicts, self.overall, self.tables.segments, run_date, dag_id)


def monitor_tagged(tagged: DataFrame, features: list[str], segments: list[str] | None = None,
                   thresholds: dict | None = None, buckets: int = 10,
                   p_value_method: str = "asymp", shared: bool = False, expected: DataFrame | None = None) -> DriftResult:
    """Drift for a frame that already has ``side`` (and segment) columns; ``shared`` and
    ``expected`` as in :class:`DriftTables`.

    Without a shared numeric column there is nothing to compare and the verdict is ok."""
    th = merge_thresholds(thresholds)
    segments = list(segments or [])
    return DriftResult(DriftTables(tagged, features, segments, buckets, shared, expected), th, p_value_method)


def monitor_drift(baseline: DataFrame, current: DataFrame, thresholds: dict | None = None,
                  buckets: int = 10, p_value_method: str = "finite") -> DriftResult:
    """Baseline and current as separate frames; features from the schemas, KS p-values for
    the sizes at hand."""
    features = feature_columns(baseline, current)
    tagged = tag_sides(baseline, current, features)
    return monitor_tagged(tagged, features, [], thresholds, buckets, p_value_method, shared=True)
