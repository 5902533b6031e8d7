"""Helpers the operators share: input columns, the learning split, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import scratch_path

HELD_OUT_REMAINDER = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text leaves remainder 1 by 3.

    A null id is hashed as the empty text, so it is never held out by a null."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == HELD_OUT_REMAINDER


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts the
    lineage, so that a lost executor costs a read and not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_rows(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learning rows (id, label, text): at most ``per_class`` ids of label 0 and of label 1.

    Ids are taken in order of a hash, so the sample is the same on every run and
    does not depend on how the table is dealt out.  Null labels, null ids and
    held-out ids are left out; of repeated ids the smallest text counts; a null
    text is empty."""
    docs = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marks = (labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label"))
             .join(docs.select("id").distinct(), "id", "left_semi"))
    order = [F.xxhash64("id"), F.col("id")]
    picked = (marks.where("label = 0").orderBy(*order).limit(per_class)
              .unionByName(marks.where("label = 1").orderBy(*order).limit(per_class)))
    rows = docs.join(F.broadcast(picked), "id")  # at most 2 * per_class ids
    return rows.groupBy("id", "label").agg(F.min("text").alias("text"))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """The learning rows as (label, text), in order of the hash."""
    rows = labelled_rows(documents, labels, label, per_class, id_col, text_col)
    return rows.orderBy(F.xxhash64("id"), "id").select("label", "text").toPandas()
