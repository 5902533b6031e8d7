"""Exponential moving averages over rows in ordered parts.

For the rows of one key, y_t = q * y_{t-1} + a * u_t with q = 1 - a.  Rows are dealt to
ranges by (key, order) and numbered p = 0, 1, ... inside (range, key); see
:mod:`driftline.operators.ranges`.  Here only the part inside a range is computed, with
y = 0 before it.  An earlier part of the key adds q^(p+1) * C, with C its last y: an
affine map, so the parts of a key compose through one number each.

Inside a range the sum is taken in blocks of p, since q^(-p) overflows in the end:

    S_j = sum_{i <= j} a * u_i * q^(-i),   y = q^j * S_j + q^(j+1) * (y at the end of the block before)

Two blocks back weigh q^(2 * block), less than the smallest normal double, so every
weight that counts is used.  All windows share one partitioning (the range) and one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.ranges import POSITION, RANGE_COL

BLOCK_COL = "_blk"
POS_COL = "_j"

# rows per block by smoothing factor: q^block is about 1e-160; the longer one is a multiple
BLOCKS = {0.01: 36_000, 0.1: 3_600}


def block_name(alpha: float) -> str:
    return f"_b{BLOCKS[alpha]}"


def add_blocks(df: DataFrame, t_col: str, block: int) -> DataFrame:
    return (df.withColumn(BLOCK_COL, F.floor(F.col(t_col) / F.lit(block)).cast("long"))
              .withColumn(POS_COL, (F.col(t_col) % F.lit(block)).cast("int")))


def part_window(keys: list[str]):
    """The rows of one key in one range, in order."""
    return Window.partitionBy(RANGE_COL, *keys).orderBy(*map(block_name, BLOCKS), POSITION)


def ema_in_range(df: DataFrame, keys: list[str], alpha: float, inputs: dict[str, str]) -> DataFrame:
    """Add ``out`` for every ``out: u`` of ``inputs``: the average inside the range alone."""
    q, size = 1.0 - alpha, BLOCKS[alpha]
    longer = [block_name(a) for a, n in BLOCKS.items() if n >= size]
    shorter = [block_name(a) for a, n in BLOCKS.items() if n < size]
    block = Window.partitionBy(RANGE_COL, *keys, *longer).orderBy(*shorter, POSITION)
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = part_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    j = (F.col(POSITION) % F.lit(size)).cast("double")
    at_end = F.col(POSITION) % F.lit(size) == size - 1
    down = F.pow(F.lit(q), j)
    rows = df.withColumns({out: F.coalesce(F.sum(F.lit(alpha) * F.col(u) * F.pow(F.lit(q), -j)).over(upto), F.lit(0.0)) * down
                           for out, u in inputs.items()})
    for _ in range(2):  # the ends of the block before, then with what it took over itself
        taken = {out: F.coalesce(F.col(f"_c_{out}"), F.lit(0.0)) if f"_c_{out}" in rows.columns else F.lit(0.0) for out in inputs}
        rows = rows.withColumns({f"_c_{out}": F.last(F.when(at_end, F.col(out) + F.lit(q ** size) * taken[out]), ignorenulls=True).over(before)
                                 for out in inputs})
    rows = rows.withColumns({out: F.col(out) + down * F.lit(q) * F.coalesce(F.col(f"_c_{out}"), F.lit(0.0)) for out in inputs})
    return rows.drop(*[f"_c_{out}" for out in inputs])
