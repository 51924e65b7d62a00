"""Bounded samples of labelled documents, and the folds of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Labelled documents of each class that a classifier is fitted on, at most: those with the least hash of their id.
SAMPLE_PER_CLASS = 2500
#: Of these, in that order, as many as have so many characters together: what the driver holds is bounded.
SAMPLE_CHARS = 16 << 20
FOLDS = 5


def held_out(key: str = "doc_id") -> Column:
    """True where crc32 of the id as text, mod 5, is 0. Null ids are never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """(text, label) of at most per_class whole documents of each class that aren't held out, with at most `chars` characters, in a fixed order.

    Rows with a null id or label are no examples; of repeated labels of an id the largest counts.
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max(label).alias("__y"))
    chosen = []
    for y in (0, 1):
        of = usable.where(F.col("__y") == y).orderBy(F.xxhash64(key), key).limit(per_class)
        chosen += [(r[0], y) for r in of.select(key).collect()]
    if not chosen:
        return []
    kind = docs.schema[key].dataType.simpleString()
    picked = docs.sparkSession.createDataFrame(chosen, f"`{key}` {kind}, __y int")  # 2 * per_class rows
    found = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked.toDF("id", "y")), "id")
    sofar = F.sum(F.length("text")).over(W.partitionBy("y").orderBy(F.xxhash64("id"), "id", "text").rowsBetween(W.unboundedPreceding, 0))
    rows = found.withColumn("sofar", sofar).where(F.col("sofar") <= chars).select("id", "y", "text").collect()  # of 2 * per_class rows at most, but for repeated ids
    return [(t, y) for _, y, t in sorted(tuple(r) for r in rows)]
