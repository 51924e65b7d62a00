"""Normalization, quality, windows, metrics and catalog operators, each a function of DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def flow_aggregate(events: DataFrame, key: str, ts: str, size: str, kind: str, kinds: list[str], bucket: str = "hour") -> DataFrame:
    """F1, G1: per key and time bucket counts, sums, mean gap in ms, distinct kinds and a count of each kind."""
    at = F.col(ts).cast("timestamp")
    with_bucket = events.withColumn("bucket", F.date_trunc(bucket, at).cast("timestamp_ntz"))
    gap = (F.unix_micros(at) - F.lag(F.unix_micros(at)).over(W.partitionBy(key, "bucket").orderBy(ts))) / 1000
    return with_bucket.withColumn("__gap", gap).groupBy(key, "bucket").agg(
        F.count(F.lit(1)).alias("packet_count"),
        F.round(F.sum(size), 4).alias("bytes_sum"),
        F.round(F.avg(size), 4).alias("bytes_mean"),
        F.round(F.coalesce(F.avg("__gap"), F.lit(0.0)), 4).alias("mean_gap_ms"),
        F.count_distinct(kind).alias("kinds"),
        *[F.count_if(F.col(kind) == k).alias(f"{k}_count") for k in kinds],
    )


def sequence_windows(rows: DataFrame, entity: str, order: list[str], label: str, rep: str, length: int, stride: int, values: list[str] = ()) -> DataFrame:
    """Sliding windows of each entity; a shorter entity has one window, padded with its last row.

    Columns: entity, window_start, label (max), rep (the last real row) and the mean of each value.
    A row is copied into ceil(length / stride) windows at most and summed at once.
    """
    w = W.partitionBy(entity)
    numbered = rows.withColumn("__r", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count(F.lit(1)).over(w))
    last = F.floor(F.greatest(F.col("__n") - length, F.lit(0)) / stride) * stride
    lowest = F.ceil(F.greatest(F.col("__r") - length + 1, F.lit(0)) / stride) * stride
    starts = F.when(lowest <= F.least(F.col("__r"), last), F.sequence(lowest.cast("bigint"), F.least(F.floor(F.col("__r") / stride) * stride, last).cast("bigint"), F.lit(stride).cast("bigint")))
    weight = F.when((F.col("__n") < length) & (F.col("__r") == F.col("__n") - 1), F.lit(length) - F.col("__n") + 1).otherwise(F.lit(1))
    spread = numbered.withColumn("__w", weight).withColumn("window_start", F.explode(starts))
    return spread.groupBy(entity, "window_start").agg(
        F.max(label).alias("label"), F.max_by(rep, "__r").alias("rep"), *[(F.sum(F.col(v) * F.col("__w")) / F.sum("__w")).alias(f"mean_{v}") for v in values]
    )


def forward_fill(value: Column, partition: list[str], order: list[str], default: float | None = None) -> Column:
    """The last value that isn't null, within a partition."""
    filled = F.last(value, ignorenulls=True).over(W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return filled if default is None else F.coalesce(filled, F.lit(default))


def missing_cells(df: DataFrame) -> DataFrame:
    """nulls over all columns, in one pass (NaN counts as missing)."""
    lost = [F.count_if(F.col(f.name).isNull() | F.isnan(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name).isNull()) for f in df.schema]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), reduce(lambda a, b: a + b, lost).alias("missing_values"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """rows beyond the first of each set of equal rows."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), (F.coalesce(F.sum("__n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_rows"))


def column_profile(df: DataFrame) -> DataFrame:
    """A row for each column with non-nulls, distinct values, longest text and score.

    Values are counted in one long table of column and value, so that partial counts leave the tasks.
    """
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    cells = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"`{c}`").cast("string").alias("v")) for k, c in enumerate(df.columns)]))
    values = df.select(cells).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    there = F.col("v").isNotNull()
    counted = values.groupBy("k").agg(F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).cast("bigint").alias("non_null"), F.count("v").alias("n_distinct"), F.max(F.length("v")).cast("bigint").alias("max_length"))
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(c in numeric).alias("is_numeric")) for c in df.columns])
    rows = counted.withColumn("x", F.get(names, F.col("k"))).select("x.column", "x.is_numeric", "non_null", "n_distinct", "max_length")
    return rows.withColumn("score", F.col("non_null") + F.least("n_distinct", F.lit(10)) * F.when(F.col("is_numeric"), 100).otherwise(50))


def select_features(profile: DataFrame, deny: list[str], limit: int = 128) -> DataFrame:
    """Usable columns by descending score, then name; texts that look like ids are left out."""
    texty = ~F.col("is_numeric") & ((F.col("n_distinct") > 64) | (F.col("n_distinct") > 0.8 * F.col("non_null")) | (F.col("max_length") > 96))
    return profile.where((F.col("non_null") > 0) & ~F.lower("column").isin(deny) & ~texty).orderBy(F.desc("score"), "column").limit(limit)


def binary_metrics(rows: DataFrame, label: str, score: str) -> DataFrame:
    """confusion counts and ratios at 0.5, 0 where a denominator is 0."""
    y, p = F.col(label) == 1, F.col(score) >= 0.5
    c = rows.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    ratio = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)), 6)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("tp", "fp", "fn", "tn", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(fp, fp + tn).alias("fpr"))


def roc_auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """by ranks with ties averaged; 0.5 for a single class.

    Labels are counted by distinct score first. Running sums over these go in two steps: within
    ranges of scores, and over the ranges' totals (a row a range).
    """
    by = rows.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("q"))
    ranged = by.repartitionByRange(score).withColumn("part", F.spark_partition_id()).select("part", score, "p", "q")
    below = F.coalesce(F.sum("q").over(W.partitionBy("part").orderBy(score).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    local = ranged.withColumn("u", F.col("p") * (below + F.col("q") / 2)).groupBy("part").agg(F.sum("u").alias("u"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    before = F.coalesce(F.sum("q").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    total = local.withColumn("u", F.col("u") + F.col("p") * before).agg(F.sum("u").alias("u"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    return total.select(F.round(F.coalesce(F.col("u") / F.nullif(F.col("p") * F.col("q"), F.lit(0)), F.lit(0.5)), 6).alias("auc"))


def one_hot(df: DataFrame, column: str, values: list[str]) -> list[Column]:
    """An indicator of each value and of null, in training order."""
    return [F.when(F.col(column) == v, 1.0).otherwise(0.0).alias(f"{column}_{v}") for v in values] + [F.when(F.col(column).isNull(), 1.0).otherwise(0.0).alias(f"{column}_nan")]


def centroids(rows: DataFrame, label: str, values: list[str]) -> DataFrame:
    """The difference of class means, and the bias of its midpoint, in one row."""
    mean = lambda c, y, d: F.coalesce(F.avg(F.when(F.col(label) == y, F.col(c))), F.lit(d))
    m = rows.agg(*[mean(c, y, float(y)).alias(f"{c}_{y}") for c in values for y in (0, 1)])
    weights = [(F.col(f"{c}_1") - F.col(f"{c}_0")).alias(f"w_{c}") for c in values]
    bias = reduce(lambda a, b: a + b, [(F.col(f"{c}_1") - F.col(f"{c}_0")) * (F.col(f"{c}_1") + F.col(f"{c}_0")) / -2 for c in values])
    return m.select(*weights, bias.alias("bias"))


def overlay(base: DataFrame, key: str, patches: DataFrame, deleted: DataFrame, columns: list[str]) -> DataFrame:
    """Patches (key, column, value) over rows that aren't deleted; a null value overrides too."""
    if not columns:
        return base.join(deleted.select(key), key, "left_anti").select(*[F.col(f"`{c}`") for c in base.columns])
    wide = patches.groupBy(key).agg(*[F.max_by(F.struct("value"), F.when(F.col("column") == c, F.col("seq"))).alias(f"__{c}") for c in columns])
    kept = base.join(deleted.select(key), key, "left_anti").join(wide, key, "left")
    return kept.select(*[F.when(F.col(f"__{c}").isNotNull(), F.col(f"__{c}.value")).otherwise(F.col(c).cast("string")).alias(c) if c in columns else F.col(c) for c in base.columns])


def latest_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the greatest order values; a max over structs, so partial sums leave the tasks."""
    rest = [c for c in rows.columns if c != key and c not in order]
    return rows.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("x")).select(key, "x.*")


def catalog_sync(found: DataFrame, known: DataFrame, key: str, referenced: DataFrame) -> DataFrame:
    """E5: insert, update, keep (missing but referenced) or delete, for each key of either side."""
    f, k, r = found.select(F.col(key).alias("f")).distinct(), known.select(F.col(key).alias("k")).distinct(), referenced.select(F.col(key).alias("r")).distinct()
    both = f.join(k, F.col("f") == F.col("k"), "full_outer").withColumn(key, F.coalesce("f", "k"))
    action = F.when(F.col("k").isNull(), "insert").when(F.col("f").isNotNull(), "update").when(F.col("r").isNotNull(), "keep").otherwise("delete")
    return both.join(r, F.col(key) == F.col("r"), "left").select(key, action.alias("action"))
