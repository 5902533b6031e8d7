"""Capabilities described for drift monitoring but given no exact definition (our semantics):

* KL divergence between baseline and current bucket shares (same buckets as PSI);
* rolling statistics and z-score outlier flags per (model, feature);
* segment-aware drift (the drift engine's segment columns);
* embedding cohesion per label and the entropy of a model's risk levels;
* signal fusion: per model min-max normalised mean drift / velocity / acceleration,
  combined with fixed weights;
* correlation of a model's features: co-moments per pair of features, which merge over
  tasks, so a model costs the square of its features in numbers and no pair of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.numeric import ordered_sum_expr, round_half_even
from driftline.operators.drift import DriftTables
from driftline.operators.ema import BLOCK_COL, POS_COL, add_blocks

ROLLING_WINDOW = 20
Z_OUTLIER = 3.0
# our weights for the fused score (drift, velocity, acceleration)
FUSION_WEIGHTS = (0.5, 0.3, 0.2)


def kl_divergence(t: DriftTables) -> DataFrame:
    """KL(baseline || current) = sum b * ln(b / c) over the PSI buckets (shares with epsilon)."""
    b = t.psi_bins()
    term = F.col("pct_baseline") * F.ln(F.col("pct_baseline") / F.col("pct_current"))
    per = b.groupBy(*t.keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("bin"), term.alias("term")))).alias("terms"))
    total = ordered_sum_expr("tv")
    per = per.withColumn("tv", F.transform("terms", lambda x: x["term"])).withColumn("kl_raw", F.expr(total))
    out = t.totals().join(per, on=t.keys, how="left")
    kl = (F.when((F.col("n_baseline") == 0) | (F.col("n_current") == 0), F.lit(None).cast("double"))
          .otherwise(F.coalesce("kl_raw", F.lit(0.0))))
    return out.select(*t.keys, round_half_even(kl, 6).alias("kl"))


def rolling_stats(rows: DataFrame, keys: list[str], value: str = "x", t_col: str = "t",
                  n: int = ROLLING_WINDOW, block: int = 1024) -> DataFrame:
    """Mean / sample std of the last ``n`` values (current included) and the z-score
    of each value against the ``n`` values before it; |z| > 3 flags an outlier.

    Rows are windowed per (key, block of positions); the last ``n`` rows of each
    block are copied into the next block as read-only context, so no window ever
    holds a whole key."""
    assert n < block
    b = add_blocks(rows, t_col, block)
    halo = (b.where(F.col(POS_COL) >= block - n)
             .withColumn(BLOCK_COL, F.col(BLOCK_COL) + 1).withColumn("_halo", F.lit(True)))
    both = b.withColumn("_halo", F.lit(False)).unionByName(halo)
    w = Window.partitionBy(*keys, BLOCK_COL).orderBy(t_col)
    cur = w.rowsBetween(-(n - 1), 0)
    prev = w.rowsBetween(-n, -1)
    out = both.select(
        "*",
        F.avg(value).over(cur).alias("_m"), F.stddev_samp(value).over(cur).alias("_s"),
        F.avg(value).over(prev).alias("_mp"), F.stddev_samp(value).over(prev).alias("_sp"),
        F.count(value).over(prev).alias("_np"))
    out = out.where(~F.col("_halo"))
    z = F.when(F.col("_np") >= 2, F.try_divide(F.col(value) - F.col("_mp"), F.col("_sp")))
    return out.select(
        *keys, t_col, value,
        round_half_even("_m", 6).alias("rolling_mean"), round_half_even("_s", 6).alias("rolling_std"),
        round_half_even(z, 4).alias("z_score"),
        F.coalesce(F.abs(z) > Z_OUTLIER, F.lit(False)).alias("outlier"))


def embedding_cohesion(emb: DataFrame, vec: str = "embedding", label: str = "label") -> DataFrame:
    """Per label: mean cosine similarity of its vectors to the label centroid."""
    rows = emb.select(F.col(label).alias("label_"), F.transform(vec, lambda x: x.cast("double")).alias("v")).where(F.size("v") > 0)
    # the cells are summed up before the shuffle: one row per label and dimension leaves a task
    mean = (rows.select("label_", F.posexplode("v").alias("dim", "x")).groupBy("label_", "dim").agg(F.avg("x").alias("x"))
            .groupBy("label_").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda c: c["x"]).alias("centre"))
            .withColumnRenamed("label_", "centre_label"))

    def dot(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    near = rows.join(mean, F.col("label_").eqNullSafe(F.col("centre_label")))  # one row per label on the right
    cos = F.try_divide(dot("v", "centre"), F.sqrt(dot("v", "v")) * F.sqrt(dot("centre", "centre")))
    return near.groupBy(F.col("label_").alias(label)).agg(F.count(F.lit(1)).alias("n_vectors"),
                                                          round_half_even(F.avg(cos), 6).alias("cohesion"))


def feature_correlation(events: DataFrame, most_features: int = 64) -> DataFrame:
    """Per model and pair of features (by name): Pearson correlation over the events that hold
    both, and their number.  An event with more than ``most_features`` usable features is an
    error, not cut: it bounds an event's pairs."""
    cell = F.filter(F.map_entries("features"), lambda e: e["value"].isNotNull() & ~F.isnan(e["value"]))
    cells = F.array_sort(F.transform(cell, lambda e: F.struct(e["key"].alias("f"), e["value"].alias("x"))))
    told = F.concat(F.lit(f"an event has more than {most_features} features: "), F.col("model"))
    rows = events.select("model", F.when(F.size(cells) <= most_features, cells)
                         .when(F.size(cells) > most_features, F.raise_error(told)).alias("cells"))
    pairs = rows.select("model", "cells", F.explode(F.col("cells")).alias("a")).select(
        "model", "a", F.explode("cells").alias("b")).where("a.f < b.f")
    made = pairs.groupBy("model", F.col("a.f").alias("feature_a"), F.col("b.f").alias("feature_b")).agg(
        F.count(F.lit(1)).alias("n"), F.corr("a.x", "b.x").alias("r"))
    return made.select("model", "feature_a", "feature_b", "n", round_half_even("r", 6).alias("correlation"))


def risk_entropy(pred: DataFrame, group: str = "model", level: str = "risk") -> DataFrame:
    """Per model: -sum p ln p over the shares of its risk levels."""
    counts = pred.groupBy(group, level).agg(F.count(F.lit(1)).alias("c"))
    tot = counts.groupBy(group).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("levels"))
    p = counts.join(tot, on=group).withColumn("p", F.col("c") / F.col("n"))
    return p.groupBy(group).agg(
        F.first("n").alias("n_predictions"), F.first("levels").alias("n_levels"),
        round_half_even(-F.sum(F.col("p") * F.ln("p")), 6).alias("entropy"))


def signal_fusion(pred: DataFrame, weights: tuple[float, float, float] = FUSION_WEIGHTS) -> DataFrame:
    """Per scored event: each model-level signal min-max normalised over the
    model's events (NULL when the model's range is 0), and their weighted sum
    over the available parts.  The per-model ranges are one aggregate with
    map-side partial aggregation, joined back on the model."""
    cols = ["avg_drift", "avg_velocity", "avg_acceleration"]
    scored = pred.where(F.col("avg_drift").isNotNull())
    rng = scored.groupBy("model").agg(*[F.min(c).alias(f"_lo_{c}") for c in cols],
                                      *[F.max(c).alias(f"_hi_{c}") for c in cols])
    j = scored.join(rng, on="model")
    norm = {c: F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) for c in cols}
    num = sum(F.coalesce(norm[c] * F.lit(w), F.lit(0.0)) for c, w in zip(cols, weights))
    den = sum(F.when(norm[c].isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in zip(cols, weights))
    return j.select("event_id", "model",
                    *[round_half_even(norm[c], 6).alias(f"norm_{c[4:]}") for c in cols],
                    round_half_even(F.try_divide(num, den), 6).alias("fused_score"))
