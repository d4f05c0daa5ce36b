"""Labelled documents for classifiers: a fixed fold and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows that a classifier is fitted on, at most.
TRAIN_ROWS = 20_000


def held_out(id_col: str = "doc_id") -> Column:
    """The test fold: crc32 of the id's text is a multiple of 5. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str,
                   rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, label) of labelled documents outside the test fold: all of
    them, or the ``rows`` with the least hash of their id. Null labels and labels
    of unknown documents are left out; of a repeated id the greatest label and the least text count."""
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
              .filter("doc_id is not null and label is not null").filter(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids and labels
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
