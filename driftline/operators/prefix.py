"""Running sums and row positions per key, without one task per key.

A plain ``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one
task; a key that holds a third of the data would then be sorted by one core.
The two-level form used here:

1. ``repartitionByRange(P, key..., order...)`` - Spark samples the sort key and cuts
   it into P ranges, so a large key is spread over many ranges;
2. the range id (``spark_partition_id``) is pinned with a reliable checkpoint into
   the shared checkpoint folder, so a lost executor cannot re-draw the ranges;
3. totals per (range, key) - at most P rows per key - give each range its offset
   through a window over that small table;
4. a window over (range, key) adds the local running sum; the offset joins back
   on (range, key).

Every window here is bounded: by the size of one range, or by P rows per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.session import ensure_checkpoint_dir

RANGE_COL = "_rng"


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared folder from ``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _num_ranges(df: DataFrame, num_ranges: int | None) -> int:
    if num_ranges:
        return num_ranges
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_split(df: DataFrame, keys: list[str], order: list, num_ranges: int | None = None) -> DataFrame:
    """Range-partition by (keys, order) and tag rows with their pinned range id."""
    n = _num_ranges(df, num_ranges)
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    return pin(ranged.withColumn(RANGE_COL, F.spark_partition_id()))


def keyed_running_sum(df: DataFrame, keys: list[str], order: list, measures: list[str],
                      prefix: str = "cum_", num_ranges: int | None = None,
                      exclusive: bool = False) -> DataFrame:
    """Add ``cum_<m>`` = running sum of ``m`` per key in ``order`` (ties broken by
    the full order list; callers pass a unique order)."""
    ranged = range_split(df, keys, order, num_ranges)
    frame = (Window.unboundedPreceding, -1) if exclusive else (Window.unboundedPreceding, Window.currentRow)
    w_local = Window.partitionBy(RANGE_COL, *keys).orderBy(*order).rowsBetween(*frame)
    local = ranged.select("*", *[F.coalesce(F.sum(m).over(w_local), F.lit(0)).alias(f"_loc_{m}")
                                 for m in measures])
    totals = ranged.groupBy(RANGE_COL, *keys).agg(*[F.sum(m).alias(f"_tot_{m}") for m in measures])
    w_off = Window.partitionBy(*keys).orderBy(RANGE_COL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(RANGE_COL, *keys,
                            *[F.coalesce(F.sum(f"_tot_{m}").over(w_off), F.lit(0)).alias(f"_off_{m}")
                              for m in measures])
    out = local.join(offsets, on=[RANGE_COL, *keys], how="inner")
    out = out.select(*df.columns,
                     *[(F.col(f"_off_{m}") + F.col(f"_loc_{m}")).alias(f"{prefix}{m}") for m in measures])
    return out


def keyed_positions(df: DataFrame, keys: list[str], order: list, name: str = "t",
                    first_cols: list[str] | None = None, num_ranges: int | None = None) -> DataFrame:
    """0-based position of each row within its key in ``order``; optionally also
    the value of ``first_cols`` at position 0 (``<col>_first``).

    ``order`` must be unique within a key.
    """
    first_cols = first_cols or []
    ranged = range_split(df, keys, order, num_ranges)
    w_local = Window.partitionBy(RANGE_COL, *keys).orderBy(*order)
    local = ranged.withColumn("_loc", F.row_number().over(w_local) - 1)
    # per (range, key): count and the first row's values (min_by over the order)
    order_struct = F.struct(*order)
    chunk = ranged.groupBy(RANGE_COL, *keys).agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.min_by(F.col(c), order_struct).alias(f"_chunk_first_{c}") for c in first_cols])
    w_off = Window.partitionBy(*keys).orderBy(RANGE_COL)
    offsets = chunk.select(
        RANGE_COL, *keys,
        F.coalesce(F.sum("_cnt").over(w_off.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        *[F.first(f"_chunk_first_{c}").over(w_off.rowsBetween(Window.unboundedPreceding, Window.currentRow))
          .alias(f"{c}_first") for c in first_cols])
    out = local.join(offsets, on=[RANGE_COL, *keys], how="inner")
    return out.select(*df.columns, (F.col("_off") + F.col("_loc")).alias(name),
                      *[F.col(f"{c}_first") for c in first_cols])
