"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the checksum of its id; a null id counts as the text of no characters."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, most_bytes: int | None = None) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents that are not held out.

    The ``rows`` labels with the smallest hashes of their ids are chosen, so a table with fewer
    labels is used whole and reruns agree. With ``most_bytes`` the sample ends, in the same order, before the row with
    which its whole texts would have more bytes. Null labels and ids are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("label"))
    known = known.where("_id IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("_id")))
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "label").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    if most_bytes is not None:
        sizes = texts.join(F.broadcast(chosen.select("_id").distinct()), "_id", "left_semi").groupBy("_id")
        sizes = sizes.agg(F.sum(F.octet_length("text")).alias("bytes"))
        so_far = F.sum("bytes").over(Window.orderBy(F.xxhash64("_id"), "_id", "label").rowsBetween(Window.unboundedPreceding, 0))
        chosen = chosen.join(sizes, "_id").select("_id", "label", so_far.alias("so_far"))  # at most ``rows`` rows
        chosen = chosen.where(F.col("so_far") <= most_bytes).drop("so_far")
    return texts.join(F.broadcast(chosen), "_id").select("_id", "text", "label")  # at most ``rows`` rows
