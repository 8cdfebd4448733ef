"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(labels: DataFrame, label_col: str, most: int, allowed: Column, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of at most ``most`` rows of each label 0 and 1: those with
    the smallest hashes of the id. An id with several labels counts with the
    largest; rows without an id or a label are left out."""
    rows = (labels.where(allowed).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
            .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label")))
    kinds = [rows.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(most) for k in (0, 1)]
    return reduce(DataFrame.union, kinds)


def texts(docs: DataFrame, sampled: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, label, text) of a sample; one row for an id, however often it occurs."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(sampled), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
