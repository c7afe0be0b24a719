"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.tables import held_out


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, per_class: int, modulus: int = 5
) -> tuple[DataFrame, dict[int, float]]:
    """At most ``per_class`` rows (doc_id, _y, text) of labelled documents of each class, and the weight of a row of each class.

    Learnable are documents with a label 0 or 1 whose crc32(doc_id) modulo ``modulus`` is not 0. Those with
    the smallest hashed ids are taken, so the sample does not depend on order or partitioning. Labels of a
    repeated id count once (the largest), and so do its rows: the smallest text is taken, before rows are shuffled.
    Weights undo the different sampling rates of the classes. The sample of ids is bounded, hence broadcast.
    """
    known = (
        labels.select("doc_id", F.col(target).cast("int").alias("_y"))
        .filter(F.col("_y").isin(0, 1) & ~held_out("doc_id", modulus, 0))
        .groupBy("doc_id")
        .agg(F.max("_y").alias("_y"))
    )
    totals = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("_y = 0").orderBy(*order).limit(per_class).unionByName(
        known.filter("_y = 1").orderBy(*order).limit(per_class)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_y").agg(F.min("text").alias("text"))
    return rows, {y: n / min(n, per_class) for y, n in totals.items()}
