"""Labelled rows for the trained operators: the fold that may teach, and a bounded sample of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that never teach: crc32 of doc_id as text leaves remainder 1 by 3 (false for a null doc_id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 3 == 1, F.lit(False))


def taught_sample(docs: DataFrame, labels: DataFrame, label: str | list[str], rows: int) -> DataFrame:
    """doc_id, text and label (or one column per label of a list) of at most ``rows`` labelled documents that may teach, chosen by a hash of doc_id.

    Only the labels are ranked (doc_id and label); the documents join on the chosen ids.  A doc_id that
    has a label as 0 and as 1 teaches as 1; one without some label does not teach.  Of documents that share a chosen doc_id one teaches, the least by hash of its text
    (nulls last), found map-side before the shuffle, so a doc_id that a third of all rows have is one row too.
    """
    names = {"label": label} if isinstance(label, str) else {n: n for n in label}
    known = labels.select("doc_id", *[F.col(c).alias(n) for n, c in names.items()]).na.drop()
    chosen = (known.filter(~held_out()).groupBy("doc_id").agg(*[F.max(n).cast("int").alias(n) for n in names])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    found = docs.select("doc_id", "text").join(chosen, "doc_id")
    first = F.min_by(F.struct("text", *names), F.struct(F.col("text").isNull(), F.xxhash64("text"), "text"))
    return found.groupBy("doc_id").agg(first.alias("first")).select("doc_id", "first.text", *[f"first.{n}" for n in names])
