"""Labelled training rows: never the held-out fold, at most a stated number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import durable, held_out


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, limit: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(_id, _t, _y)``: texts with a 0/1 label outside the held-out fold.

    At most ``limit`` label rows are used, chosen by a hash of their id, so
    the choice does not depend on order or partitioning. An id labelled twice
    counts as labelled 1 if any of its labels is. The ids, not the texts, are
    broadcast: ``limit`` rows at most.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("_k"), F.col(label_col).cast("int").alias("_y"))
             .filter(F.col("_y").isin(0, 1) & F.col("_k").isNotNull() & ~held_out(F.col("_k")))
             .groupBy("_k").agg(F.max("_y").alias("_y"))
             .orderBy(F.xxhash64("_k"), "_k").limit(limit))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return durable(rows.join(F.broadcast(known), F.col("_id") == F.col("_k")).select("_id", "_t", "_y"), "training")
