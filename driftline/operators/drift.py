"""Batch drift between a baseline and a current sample, per feature.

Input: one DataFrame with segment columns (e.g. ``scenario`` or ``run_date``), a
``side`` column (``'b'`` baseline / ``'c'`` current) and numeric feature columns.  With a
shared baseline its rows stand there once, with null segments, and every segment is
compared with them; otherwise a segment has a baseline of its own.

Everything flows from one unpivot and one ECDF table:

    long  (seg..., feature, side, value)          -- nulls / NaN dropped per side
    ecdf  (seg..., feature, value, n_b, n_c, own_b, cum_n_b, cum_n_c, all_b, all_c)

Distinct values of both sides lie in one order (range-partitioned by feature and value,
so a hot feature is many tasks' work): the baseline is ranked once, and the current
values of any number of segments are located in it by the same running sums.  No row of
the baseline is copied.

* PSI edges: order statistics of the baseline read off ``cum_n_b`` (numpy's linear
  interpolation, then unique edges), once per baseline;
* bin counts: each distinct value falls in one bin of its baseline's edges;
* KS D: the step functions differ most at a current value or just before one, so
  ``max |F_b - F_c|`` is taken there and needs the current rows only;
* mean / variance shift: one grouped aggregate over ``long``.

Each of these reads the ECDF once: what it leaves (sums per range, edges, bin counts, KS D,
moments: a few rows per group) is pinned, and all that is derived reads those small tables.

Tables of a shared baseline have a few rows per feature and are broadcast; for the others
the runtime sizes decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType)

import pandas as pd

from driftline.functions.kolmogorov import kolmogorov_sf_expr, ks_pvalue
from driftline.functions.numeric import is_finite_value, ordered_sum_expr, round_half_even
from driftline.functions.severity import psi_severity
from driftline.operators.prefix import RANGE_COL, pin
from driftline.operators.ranges import pin_in_place

NUMERIC_TYPES = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)

# Fixed values (defaults of the drift library): 10 buckets, epsilon 1e-4 added to
# every bucket share, KS p-value threshold 0.05, mean shift 10 %, variance shift 20 %.
DEFAULT_BUCKETS = 10
PSI_EPSILON = 1e-4
SHIFT_EPSILON = 1e-9


def feature_columns(baseline: DataFrame, current: DataFrame) -> list[str]:
    """Numeric baseline columns that the current side also has, minus ``_*`` columns
    (booleans are not numeric here).  Schema only: no data is read."""
    cur = set(current.columns)
    out = []
    for f in baseline.schema.fields:
        if isinstance(f.dataType, BooleanType) or not isinstance(f.dataType, NUMERIC_TYPES):
            continue
        if f.name in cur and not f.name.startswith("_"):
            out.append(f.name)
    return out


def tag_sides(baseline: DataFrame, current: DataFrame, features: list[str],
              segments: list[str] | None = None) -> DataFrame:
    """Union of a shared baseline, once and with null segments, and the current rows."""
    kinds = {f.name: f.dataType for f in current.schema.fields}
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in segments or []]
    b = baseline.select(*none, *features, F.lit("b").alias("side"))
    return b.unionByName(current.select(*(segments or []), *features, F.lit("c").alias("side")))


def unpivot(tagged: DataFrame, features: list[str], segments: list[str]) -> DataFrame:
    """(seg..., side, f1, f2, ...) -> (seg..., side, feature_idx, value), finite only."""
    if not features:  # nothing to compare: no rows
        return tagged.select(*segments, "side", F.lit(0).alias("feature_idx"), F.lit(0.0).alias("value")).where("false")
    cells = F.array(*[F.struct(F.lit(i).alias("feature_idx"), F.col(f).cast("double").alias("value"))
                      for i, f in enumerate(features)])
    stacked = tagged.select(*[F.col(s) for s in segments], "side", F.explode(cells).alias("_u"))
    stacked = stacked.select(*segments, "side", "_u.feature_idx", "_u.value")
    return stacked.where(is_finite_value("value"))


def feature_name(features: list[str]):
    """The feature name for ``feature_idx`` (the shuffles carry the index only)."""
    return F.element_at(F.array(*[F.lit(f) for f in features or [""]]), F.col("feature_idx") + 1)


def _finite_p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    known = ~(d.isna() | n1.isna() | n2.isna() | (n1 == 0) | (n2 == 0))
    return pd.Series([ks_pvalue(float(dv), int(a), int(b)) if ok else None for dv, a, b, ok in zip(d, n1, n2, known)],
                     dtype="float64")


def _finite_p_udf(*cols):
    # built on first use (a pandas UDF needs a running session)
    return F.pandas_udf(_finite_p, "double")(*cols)


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", small: bool = False) -> DataFrame:
    """Join in which null keys match; ``small``: the right side is bounded and broadcast."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(F.broadcast(other) if small else other, cond, how).drop(*[f"_r_{k}" for k in keys])


class DriftTables:
    """Lazily built tables that the PSI, KS and shift outputs share.

    ``shared``: the baseline rows have null segments and count for every segment with
    current rows; ``expected`` names further segments (a table of the segment columns)."""

    def __init__(self, tagged: DataFrame, features: list[str], segments: list[str] | None = None,
                 buckets: int = DEFAULT_BUCKETS, shared: bool = False, expected: DataFrame | None = None):
        self.segments = list(segments or [])
        self.features = list(features)
        self.buckets = buckets
        self.shared = shared or not self.segments
        self.expected = expected
        self.keys = [*self.segments, "feature_idx", "feature"]
        self.ikeys = [*self.segments, "feature_idx"]       # what the large shuffles carry
        self.bkeys = ["feature_idx"] if self.shared else self.ikeys   # of a baseline
        self.long = unpivot(tagged, self.features, self.segments)
        self._pinned = None
        self._small: dict[str, DataFrame] = {}

    def _once(self, name: str, made: Callable[[], DataFrame]) -> DataFrame:
        """A small table, pinned when it is first asked for: its big input is read once."""
        if name not in self._small:
            self._small[name] = pin(made())
        return self._small[name]

    # -- one row per baseline, one per segment ----------------------------------
    def paired(self, both: DataFrame, base: list[str], cur: list[str], has_b: str, has_c: str) -> DataFrame:
        """A table of groups (``ikeys``), the baseline's columns and the segment's side by side."""
        if not self.shared:
            return both.withColumn("feature", feature_name(self.features)).select(*self.keys, *base, *cur)
        b = both.where(F.col(has_b) > 0).select("feature_idx", *base)
        c = both.where(F.col(has_c) > 0).select(*self.ikeys, *cur)
        if self.segments:
            known = c.select(*self.segments)
            known = (known if self.expected is None else known.unionByName(self.expected.select(*self.segments))).distinct()
        else:
            known = both.sparkSession.range(1).select()
        grid = known.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(self.features))]).cast("array<int>")).alias("feature_idx"))
        out = matched(matched(grid, b, ["feature_idx"], small=True), c, self.ikeys)
        return out.withColumn("feature", feature_name(self.features)).select(*self.keys, *base, *cur)

    # -- ECDF -----------------------------------------------------------------
    def counts(self) -> DataFrame:
        """Distinct values with both sides' counts.  The value leads: what does not fit in memory is
        sorted by these columns, and a leading segment would be equal for most rows."""
        return self.long.groupBy("value", *self.ikeys).agg(
            F.count_if(F.col("side") == "b").alias("n_b"), F.count_if(F.col("side") == "c").alias("n_c"))

    def pinned(self) -> DataFrame:
        """Distinct values in pinned ranges, with running counts inside a range."""
        if self._pinned is None:
            counts = self.counts()
            n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            # equal values of a feature share a range, whatever segment they are of
            ranged = counts.repartitionByRange(n, *self.bkeys, "value").withColumn(RANGE_COL, F.spark_partition_id())
            dealt = ranged.repartitionById(n, F.col(RANGE_COL))
            place = Window.partitionBy(RANGE_COL, *self.bkeys).orderBy("value")
            mine = Window.partitionBy(RANGE_COL, *self.ikeys).orderBy("value")
            self._pinned = pin_in_place(dealt.select(
                "*", F.sum("n_b").over(place.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("upto_b"),
                F.sum("n_b").over(place.rangeBetween(Window.currentRow, Window.currentRow)).alias("own_b"),
                F.sum("n_c").over(mine.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("upto_c")))
        return self._pinned

    def range_sums(self) -> DataFrame:
        """Both sides' counts per range and group in it."""
        return self._once("sums", lambda: self.pinned().groupBy(RANGE_COL, *self.ikeys).agg(
            F.sum("n_b").alias("n_b"), F.sum("n_c").alias("n_c")))

    def _offsets(self, keys: list[str], n: str, name: str) -> DataFrame:
        """Per range and group in it: the counts of the ranges before, and of all ranges.  For a
        shared baseline these are a few more rows than ranges and features."""
        per = self.range_sums().groupBy(RANGE_COL, *keys).agg(F.sum(n).alias("_s"))
        every = Window.partitionBy(*keys)
        before = every.orderBy(RANGE_COL).rowsBetween(Window.unboundedPreceding, -1)
        return per.select(RANGE_COL, *keys, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias(f"_off_{name}"),
                          F.sum("_s").over(every).alias(f"all_{name}"))

    def _ranked(self, rows: DataFrame) -> DataFrame:
        return matched(rows, self._offsets(self.bkeys, "n_b", "b"), [RANGE_COL, *self.bkeys], small=self.shared)

    def ecdf(self) -> DataFrame:
        """Each row's running counts over all ranges; both sides' sizes."""
        rows = matched(self._ranked(self.pinned()), self._offsets(self.ikeys, "n_c", "c"), [RANGE_COL, *self.ikeys])
        return rows.select(*self.ikeys, feature_name(self.features).alias("feature"), "value", "n_b", "n_c", "own_b",
                           (F.col("_off_b") + F.col("upto_b")).alias("cum_n_b"),
                           (F.col("_off_c") + F.col("upto_c")).alias("cum_n_c"), "all_b", "all_c")

    def totals(self) -> DataFrame:
        """Per group sample sizes (after the per-side null/NaN drop)."""
        return self._sizes(self.range_sums().groupBy(*self.ikeys).agg(F.sum("n_b").alias("nb"), F.sum("n_c").alias("nc")))

    def sizes(self) -> DataFrame:
        """The totals alone: one aggregate over the data, no order and no pin."""
        return self._sizes(self.long.groupBy(*self.ikeys).agg(F.count_if(F.col("side") == "b").alias("nb"),
                                                              F.count_if(F.col("side") == "c").alias("nc")))

    def _sizes(self, counts: DataFrame) -> DataFrame:
        out = self.paired(counts, ["nb"], ["nc"], "nb", "nc")
        out = out.select(*self.keys, F.coalesce("nb", F.lit(0)).alias("n_baseline"), F.coalesce("nc", F.lit(0)).alias("n_current"))
        return out.where("n_baseline + n_current > 0")

    # -- PSI ------------------------------------------------------------------
    def edge_targets(self) -> DataFrame:
        """Positions of the baseline order statistics needed for each edge."""
        sizes = self.range_sums().groupBy(*self.bkeys).agg(F.sum("n_b").alias("n_baseline")).where("n_baseline > 0")
        t = sizes.select(*self.bkeys, "n_baseline", F.explode(F.sequence(F.lit(0), F.lit(self.buckets))).alias("k"))
        # numpy: percent_k = k * (100 / buckets) (last one exactly 100), q = percent / 100,
        # virtual index = (n - 1) * q
        step = 100.0 / float(self.buckets)
        pct = F.when(F.col("k") == self.buckets, F.lit(100.0)).otherwise(F.col("k").cast("double") * F.lit(step))
        t = t.withColumn("vi", (F.col("n_baseline") - 1).cast("double") * (pct / F.lit(100.0))).withColumn("lo", F.floor("vi"))
        return (t.withColumn("hi", F.least(F.col("lo") + 1, F.col("n_baseline") - 1))
                .withColumn("frac", F.col("vi") - F.col("lo")))

    def baseline_edges(self) -> DataFrame:
        """(bkeys..., edges array<double>): sorted unique percentile edges of every baseline."""
        return self._once("edges", self._baseline_edges)

    def _baseline_edges(self) -> DataFrame:
        look = self.edge_targets().select(*self.bkeys, "k", "frac", "lo", "hi")
        e = self._ranked(self.pinned().where("n_b > 0"))
        e = e.select(*self.bkeys, "value", (F.col("_off_b") + F.col("upto_b") - 1).alias("last_rank"),
                     (F.col("_off_b") + F.col("upto_b") - F.col("n_b")).alias("first_rank"))
        hit = [F.col("last_rank") >= F.col(r) for r in ("lo", "hi")], [F.col("first_rank") <= F.col(r) for r in ("lo", "hi")]
        low, high = (a & b for a, b in zip(*hit))
        found = matched(e, look, self.bkeys, "inner", small=self.shared).where(low | high)
        pts = found.groupBy(*self.bkeys, "k", "frac").agg(F.max(F.when(low, F.col("value"))).alias("a"),
                                                          F.max(F.when(high, F.col("value"))).alias("b"))
        diff = F.col("b") - F.col("a")
        edge = (F.when(F.col("frac") >= 0.5, F.col("b") - diff * (F.lit(1.0) - F.col("frac")))
                .otherwise(F.col("a") + diff * F.col("frac")))
        return pts.groupBy(*self.bkeys).agg(F.array_distinct(F.array_sort(F.collect_list(edge))).alias("edges"))

    def edges(self) -> DataFrame:
        """(keys..., edges array<double>) of every group with a baseline."""
        groups = self.totals().where("n_baseline > 0").select(*self.keys)
        return matched(groups, self.baseline_edges(), self.bkeys, "inner", small=self.shared)

    def bin_counts(self) -> DataFrame:
        """(keys..., bin, n_b, n_c): numpy.histogram bins [e_i, e_i+1), last closed,
        values outside the edges not counted.  A shared baseline's counts have null segments."""
        return self._once("bins", self._bin_counts)

    def _bin_counts(self) -> DataFrame:
        j = matched(self.pinned().select(*self.ikeys, "value", "n_b", "n_c"), self.baseline_edges(), self.bkeys, "inner",
                    small=self.shared)
        n_edges = F.size("edges")
        # number of edges <= value, unrolled over the (at most buckets + 1) edges so the
        # expression stays in generated code
        below = sum((F.coalesce(F.get(F.col("edges"), i) <= F.col("value"), F.lit(False))).cast("int")
                    for i in range(self.buckets + 1))
        bin_ = F.when(F.col("value") == F.element_at("edges", -1), n_edges - 2).otherwise(below - 1)
        j = j.where((n_edges >= 2) & (F.col("value") >= F.element_at("edges", 1))
                    & (F.col("value") <= F.element_at("edges", -1)))
        return j.groupBy(*self.ikeys, bin_.alias("bin")).agg(F.sum("n_b").alias("n_b"), F.sum("n_c").alias("n_c"))

    def psi_bins(self) -> DataFrame:
        """Every bin of every group, empty bins included, with both shares."""
        edges = matched(self.totals().where("n_baseline > 0"), self.baseline_edges(), self.bkeys, "inner", small=self.shared)
        bins = F.when(F.size("edges") >= 2, F.sequence(F.lit(0), F.size("edges") - 2)).otherwise(
            F.array().cast("array<int>"))
        all_bins = edges.select("*", F.explode(bins).alias("bin"))
        counts = self.bin_counts()
        b = counts.where("n_b > 0").groupBy(*self.bkeys, "bin").agg(F.sum("n_b").alias("cnt_b"))
        c = counts.where("n_c > 0").select(*self.ikeys, "bin", F.col("n_c").alias("cnt_c"))
        out = matched(matched(all_bins, b, [*self.bkeys, "bin"], small=self.shared), c, [*self.ikeys, "bin"])
        out = out.select(
            *self.keys, "bin",
            F.element_at("edges", F.col("bin") + 1).alias("lower"),
            F.element_at("edges", F.col("bin") + 2).alias("upper"),
            F.coalesce("cnt_b", F.lit(0)).alias("count_baseline"),
            F.coalesce("cnt_c", F.lit(0)).alias("count_current"),
            "n_baseline", "n_current")
        pct_b = F.try_divide(F.col("count_baseline").cast("double"), F.col("n_baseline").cast("double")) + F.lit(PSI_EPSILON)
        pct_c = F.try_divide(F.col("count_current").cast("double"), F.col("n_current").cast("double")) + F.lit(PSI_EPSILON)
        return out.withColumn("pct_baseline", pct_b).withColumn("pct_current", pct_c)

    def psi(self, warning: float = 0.1, critical: float = 0.2) -> DataFrame:
        """(keys..., psi, severity); PSI rounded to 6, severity from the raw value."""
        b = self.psi_bins()
        term = (F.col("pct_current") - F.col("pct_baseline")) * F.ln(F.col("pct_current") / F.col("pct_baseline"))
        per = b.groupBy(*self.keys).agg(
            F.array_sort(F.collect_list(F.struct(F.col("bin"), term.alias("term")))).alias("terms"))
        total = ordered_sum_expr("tv")
        per = per.withColumn("tv", F.transform("terms", lambda x: x["term"])).withColumn("psi_raw", F.expr(total))
        # groups with < 2 unique edges have no bins: PSI 0.0 (constant baseline)
        out = matched(self.totals(), per, self.keys).withColumn(
            "psi_raw",
            F.when((F.col("n_baseline") == 0) | (F.col("n_current") == 0), F.lit(None).cast("double"))
            .otherwise(F.coalesce("psi_raw", F.lit(0.0))))
        return out.select(*self.keys, round_half_even("psi_raw", 6).alias("psi"),
                          psi_severity(F.col("psi_raw"), warning, critical).alias("severity"))

    # -- KS -------------------------------------------------------------------
    def ks(self, p_value_threshold: float = 0.05, p_value_method: str = "asymp") -> DataFrame:
        """(keys..., ks_statistic, p_value, drifted).

        ``p_value_method`` is the caller's choice: ``asymp`` is the Kolmogorov series in SQL,
        ``finite`` the probability for the given sizes (:func:`ks_pvalue`), in a pandas UDF
        over the per-feature rows (sizes and D, never the data) with bounded work."""
        out = matched(self.totals(), self._once("ks", self._ks_distance), self.ikeys).withColumn("ks_statistic", round_half_even("d_raw", 6))
        p = F.expr(kolmogorov_sf_expr("d_raw", "n_baseline", "n_current"))
        if p_value_method == "finite":
            p = _finite_p_udf(F.col("d_raw"), F.col("n_baseline"), F.col("n_current"))
        elif p_value_method != "asymp":
            raise ValueError(f"unknown p_value_method {p_value_method!r}")
        out = out.withColumn("p_value", round_half_even(p, 6))
        return out.select(*self.keys, "ks_statistic", "p_value",
                          F.coalesce(F.col("p_value") < F.lit(p_value_threshold), F.lit(False)).alias("drifted"))

    def _ks_distance(self) -> DataFrame:
        e = self.ecdf().where("n_c > 0 AND all_b > 0")
        at = F.abs(F.col("cum_n_b") / F.col("all_b") - F.col("cum_n_c") / F.col("all_c"))
        before = F.abs((F.col("cum_n_b") - F.col("own_b")) / F.col("all_b") - (F.col("cum_n_c") - F.col("n_c")) / F.col("all_c"))
        return e.groupBy(*self.ikeys).agg(F.max(F.greatest(at, before)).alias("d_raw"))

    # -- mean / variance shift ------------------------------------------------
    def _moments(self) -> DataFrame:
        b = F.col("side") == "b"
        c = F.col("side") == "c"
        return self.long.groupBy(*self.ikeys).agg(
            F.avg(F.when(b, F.col("value"))).alias("bm"), F.avg(F.when(c, F.col("value"))).alias("cm"),
            F.var_samp(F.when(b, F.col("value"))).alias("bv"), F.var_samp(F.when(c, F.col("value"))).alias("cv"),
            F.count_if(b).alias("nb"), F.count_if(c).alias("nc"))

    def shift(self, once: bool = False) -> DataFrame:
        """``once``: its moments are pinned, for an output that is read several times."""
        moments = self._once("moments", self._moments) if once else self._moments()
        agg = self.paired(moments, ["bm", "bv", "nb"], ["cm", "cv", "nc"], "nb", "nc").where("coalesce(nb, 0) + coalesce(nc, 0) > 0")
        mean_pct = F.abs(F.col("cm") - F.col("bm")) / (F.abs(F.col("bm")) + F.lit(SHIFT_EPSILON)) * F.lit(100.0)
        var_pct = F.abs(F.col("cv") - F.col("bv")) / (F.abs(F.col("bv")) + F.lit(SHIFT_EPSILON)) * F.lit(100.0)
        return agg.select(
            *self.keys,
            round_half_even("bm", 6).alias("baseline_mean"),
            round_half_even("cm", 6).alias("current_mean"),
            round_half_even(mean_pct, 2).alias("mean_shift_pct"),
            round_half_even("bv", 6).alias("baseline_var"),
            round_half_even("cv", 6).alias("current_var"),
            round_half_even(var_pct, 2).alias("var_shift_pct"))
