"""Severity ladder shared by the drift verdicts and the alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The severities are ok < warning < critical.


def rank_of(status: Column) -> Column:
    """Rank of a status string; anything unknown ranks like ``ok``."""
    return (F.when(status == "warning", 1)
            .when(status == "critical", 2)
            .otherwise(0))


def status_of(rank: Column) -> Column:
    return (F.when(rank >= 2, "critical")
            .when(rank == 1, "warning")
            .otherwise("ok"))


def psi_severity(psi: Column, warning: float = 0.1, critical: float = 0.2) -> Column:
    """``< warning`` ok, ``< critical`` warning, else critical; a NULL PSI (no data
    on a side) gives ``insufficient_data`` instead of the NaN -> critical slip."""
    return (F.when(psi.isNull(), "insufficient_data")
            .when(psi < warning, "ok")
            .when(psi < critical, "warning")
            .otherwise("critical"))
