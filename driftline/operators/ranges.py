"""Rows of many keys in ordered parts, and what goes over the border of two parts.

A key with no more rows than a fair share of a task stays whole: rows are dealt by a hash
of the key, and nothing more is needed.  Keys with more rows (fewer than there are tasks)
are cut by range partitioning on (key, order), in which all rows of another key are equal
and stay together.  The range ids are then pinned with a reliable checkpoint.  It keeps its
partitioning and order, so windows per (range, key ...) on it need no shuffle and no sort.

A border of two ranges cuts at most one key.  What a later part of a key must know of the
earlier ones is therefore a table of at most one row per range, however many keys there
are: it is collected, folded in the order of the ranges, and broadcast back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from driftline.operators.prefix import RANGE_COL, ensure_checkpoint_dir

POSITION = "_p"


def pin_in_place(df: DataFrame) -> DataFrame:
    """A reliable checkpoint that keeps partitioning and order.

    Only a plan that is final when it is checkpointed hands these on, so adaptive
    execution rests for this one write."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    name = "spark.sql.adaptive.enabled"
    adaptive = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(name, adaptive)


def heavy_keys(df: DataFrame, keys: list[str], parts: int) -> list[tuple]:
    """Keys with more rows than the mean of ``parts`` equal parts: fewer than ``parts``.

    One aggregate; of its rows the largest ``parts`` and the sum come to the driver."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = Observation("rows")
    most = counts.observe(total, F.sum("_n").alias("rows")).orderBy(F.desc("_n"), *keys).limit(parts).collect()
    rows = total.get["rows"] or 0
    return [tuple(r)[:-1] for r in most if r["_n"] * parts > rows]


def ordered_parts(df: DataFrame, keys: list[str], order: list[str], blocks: dict[str, int],
                  num_ranges: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` with ``_rng``, the position ``_p`` inside (range, key) and one column per entry of
    ``blocks`` (name: rows, longest first); and whether any key is cut.

    Rows without a value in the first of ``order`` come first and get position -1: they carry
    what is known of a key from before, at most one a key."""
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(df, keys, n)
    if heavy:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        table = df.sparkSession.createDataFrame([(*k, True) for k in heavy], ", ".join(f"_h_{k} {kinds[k]}" for k in keys) + ", _heavy boolean")
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
        marked = df.join(F.broadcast(table), same, "left").drop(*[f"_h_{k}" for k in keys])  # at most n rows
        cuts = [F.when(F.col("_heavy"), F.col(c)) for c in order]
        ranged = marked.repartitionByRange(n, *keys, *cuts).drop("_heavy").withColumn(RANGE_COL, F.spark_partition_id())
        dealt = ranged.repartitionById(n, F.col(RANGE_COL))
    else:
        dealt = df.repartition(n, *keys).withColumn(RANGE_COL, F.spark_partition_id())
    inside = Window.partitionBy(RANGE_COL, *keys).orderBy(*order)
    known = F.first(F.col(order[0]).isNull()).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = dealt.withColumn(POSITION, (F.row_number().over(inside) - 1 - known.cast("int")).cast("long"))
    rows = rows.withColumns({name: F.floor(F.col(POSITION) / F.lit(size)) for name, size in blocks.items()})
    rows = rows.sortWithinPartitions(RANGE_COL, *keys, *blocks, POSITION)
    return (pin_in_place(rows), True) if heavy else (rows, False)


@dataclass
class Border:
    """The key that goes on from range ``left`` to the next range that has rows, ``right``;
    ``rows`` of it lie in ``left``; ``inner`` says that it came over a border itself."""

    left: int
    right: int
    key: tuple
    rows: int
    inner: bool


def borders(rows: DataFrame, keys: list[str]) -> list[Border]:
    """The borders that cut a key, in order: one small aggregate, a row per range."""
    key = F.struct(*keys)
    found = rows.groupBy(RANGE_COL).agg(F.min(key).alias("first"), F.max(key).alias("last"),
                                        F.max_by(F.col(POSITION), F.struct(*keys, POSITION)).alias("p")).collect()
    out: list[Border] = []
    found.sort(key=lambda r: r[RANGE_COL])
    for a, b in zip(found, found[1:]):
        if a["last"] == b["first"]:
            inner = bool(out) and out[-1].right == a[RANGE_COL] and out[-1].key == tuple(a["last"])
            out.append(Border(a[RANGE_COL], b[RANGE_COL], tuple(a["last"]), a["p"] + 1, inner))
    return out


def _same(keys: list[str]) -> Column:
    cond = F.col(RANGE_COL) == F.col("_b_rng")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return cond


def _table(rows: DataFrame, keys: list[str], entries: list[tuple], columns: str) -> DataFrame:
    """A broadcast table with one row per border; each entry is (range, key, *values)."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(["_b_rng int", *[f"_b_{k} {kinds[k]}" for k in keys]]) + (f", {columns}" if columns else "")
    return F.broadcast(rows.sparkSession.createDataFrame([(r, *key, *values) for r, key, *values in entries], schema))


def with_carry(rows: DataFrame, keys: list[str], found: list[Border], carries: list[tuple], columns: str) -> DataFrame:
    """Add ``columns`` to the rows of every key that came over a border (null elsewhere)."""
    table = _table(rows, keys, [(b.right, b.key, *c) for b, c in zip(found, carries, strict=True)], columns)
    joined = rows.join(table, _same(keys), "left")
    return joined.drop("_b_rng", *[f"_b_{k}" for k in keys])


def before_borders(rows: DataFrame, keys: list[str], found: list[Border]) -> DataFrame:
    """Only the rows of cut keys before their borders, with the number ``_n`` of the part's rows."""
    table = _table(rows, keys, [(b.left, b.key, b.rows) for b in found], "_n long")
    return rows.join(table, _same(keys)).drop("_b_rng", *[f"_b_{k}" for k in keys])
