"""The bounded sample of labelled documents that a classifier is fitted on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; null for a null doc_id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def sample(documents: DataFrame, labels: DataFrame, label: str, train: Column, each: int) -> pd.DataFrame:
    """text and label (0 or 1) of at most each rows of either label among the rows of labels where train holds.

    The rows are chosen by a hash of doc_id, from the label table alone, so at most 2 * each small rows are broadcast
    to the scan of the documents. Null and other labels take no part; of repeated doc_ids the larger label counts, and
    of their texts the least one, so that at most 2 * each texts reach the driver."""
    rows = labels.where(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    order = F.xxhash64("doc_id", F.lit(41))
    chosen = rows.where("label = 1").orderBy(order, "doc_id").limit(each).union(rows.where("label = 0").orderBy(order, "doc_id").limit(each))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text"))
    return met.toPandas().sort_values("doc_id").reset_index(drop=True)[["text", "label"]]
