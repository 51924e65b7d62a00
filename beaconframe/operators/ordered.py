"""Ordered operations that no single task does: rows are sorted in ranges, and only a row for each range goes to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from beaconframe.session import cut

PART = "__part"


def ranged(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """The rows in ranges of the order, with the range's number; checkpointed, so that ranges are the same whenever they are read."""
    return cut(rows.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def rank(rows: DataFrame, by: list[str], order: list[Column | str], name: str = "rank", count: str | None = None) -> DataFrame:
    """Number of each row from 1, by the order within the groups of `by`, and the group's rows as `count`; a group may lie in many ranges."""
    parts = ranged(rows, [*by, *order])
    sizes = parts.groupBy(PART, *by).agg(F.count(F.lit(1)).alias("__n"))
    within = W.partitionBy(*by)
    before = F.coalesce(F.sum("__n").over(within.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(PART, *by, before.alias("__before"), F.sum("__n").over(within).alias("__all")) if by else sizes.select(PART, F.coalesce(F.sum("__n").over(W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(W.partitionBy(F.lit(0))).alias("__all"))  # a row for each range and group
    numbered = parts.withColumn("__r", F.row_number().over(W.partitionBy(PART, *by).orderBy(*order)))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (PART, *by)]
    joined = numbered.alias("r").join(starts.alias("s"), same)
    more = [F.col("__all").alias(count)] if count else []
    return joined.select(*[F.col(f"r.`{c}`") for c in rows.columns], (F.col("__r") + F.col("__before")).cast("bigint").alias(name), *more)


def fill(rows: DataFrame, value: str, by: list[str], order: list[Column | str], default: object = None) -> DataFrame:
    """Rows with `value` filled by the last one that isn't null in the order, within the groups of `by` (one group if empty).

    Ranges are filled apart. Only the last group of a range can go on in the next, so that a
    row for each range is enough to carry values over.
    """
    parts = ranged(rows, [*by, *order])
    w = W.partitionBy(PART, *by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = F.last(value, ignorenulls=True).over(w)
    key = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in by], F.lit(0))
    ends = parts.groupBy(PART, *by).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("v")).withColumn("key", key)
    last = ends.groupBy(PART).agg(F.max_by(F.struct(*by, "v"), "key").alias("x"), F.min("key").alias("first")).orderBy(PART).collect()
    carried, held, held_key, schema = [], None, None, {f.name: f.dataType.simpleString() for f in rows.schema}
    for r in last:
        mine = tuple(r["x"][c] for c in by)
        if held is not None:
            carried.append((r[PART], *held_key, held))
        if r["x"]["v"] is not None or mine != held_key:
            held, held_key = r["x"]["v"], mine
    out = parts.withColumn(value, local)
    if carried:
        names = ", ".join(f"`s{k}` {schema[c]}" for k, c in enumerate(by))
        carry = rows.sparkSession.createDataFrame(carried, f"p int, {names + ', ' if names else ''}carry {schema[value]}")
        on = [F.col(PART) == F.col("p"), *[F.col(c).eqNullSafe(F.col(f"s{k}")) for k, c in enumerate(by)]]
        out = out.join(F.broadcast(carry), on, "left").withColumn(value, F.coalesce(F.col(value), F.col("carry")))  # a row for each range
    filled = F.col(value) if default is None else F.coalesce(F.col(value), F.lit(default))
    return out.select(*[filled.alias(c) if c == value else F.col(f"`{c}`") for c in rows.columns])


def ordinal(rows: DataFrame, name: str = "row_index") -> DataFrame:
    """Rows numbered from 0 in the order in which they are read, without a gap; checkpointed."""
    numbered = cut(rows.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    sizes = sorted((r["p"], r["n"]) for r in numbered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each task
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    first = rows.sparkSession.createDataFrame(starts, "p bigint, before bigint")
    joined = numbered.join(F.broadcast(first), part == F.col("p"))
    return joined.select((F.col("before") + F.col("__id") - F.shiftleft("p", 33)).alias(name), *[F.col(f"`{c}`") for c in rows.columns])
