"""Metadata tables: lookups, fallbacks, synchronisation, queues and deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.functions import columns as C


def sync(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Insert, update or delete for each key of either side."""
    f, k = found.select(F.col(key).alias("f")).distinct(), known.select(F.col(key).alias("k")).distinct()
    action = F.when(F.col("k").isNull(), "insert").when(F.col("f").isNotNull(), "update").otherwise("delete")
    return f.join(k, F.col("f") == F.col("k"), "full_outer").select(F.coalesce("f", "k").alias(key), action.alias("action"))


def zipped(left: DataFrame, right: DataFrame, index: str) -> DataFrame:
    """Rows of two tables of equal numbering side by side; an index that one side alone has is an error."""
    both = left.join(right.withColumnRenamed(index, "__other"), F.col(index) == F.col("__other"), "full_outer")
    if not both.where(F.col(index).isNull() | F.col("__other").isNull()).isEmpty():
        raise ValueError("the tables differ in length")
    return both.drop("__other")


def with_fallback(rows: DataFrame, key: str, preferred: DataFrame, value: str, own: str) -> DataFrame:
    """Column `value` of the preferred row of the same key, else the row's own."""
    best = preferred.groupBy(F.col(key).alias("__key")).agg(F.max(value).alias("__value"))
    return rows.join(best, F.col(key) == F.col("__key"), "left").select(*[F.col(f"`{c}`") for c in rows.columns if c != value], F.coalesce("__value", own).alias(value))


def invalidated(datasets: DataFrame, changed: DataFrame, path: str, status: str = "pending") -> DataFrame:
    """Datasets whose raw path is among the changed ones have the status."""
    hit = changed.select(F.col(path).alias("__path")).distinct().withColumn("__hit", F.lit(True))
    return datasets.join(hit, F.col(path) == F.col("__path"), "left").select(*[(F.when(F.col("__hit"), status).otherwise(F.col("status")) if c == "status" else F.col(f"`{c}`")).alias(c) for c in datasets.columns])


def under(rows: DataFrame, path: str, folder: str) -> DataFrame:
    """Rows whose path lies in a folder."""
    return rows.where(F.startswith(F.col(path), F.lit(folder.rstrip("/") + "/")) | (F.col(path) == folder.rstrip("/")))


def named(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Rows of a name in any case."""
    return rows.where(F.lower(F.trim(F.col(column))) == name.strip().lower())


def either(rows: DataFrame, first: str, names: list, second: str, others: list) -> DataFrame:
    """Rows that are in one list or the other."""
    return rows.where(F.col(first).isin(names) | F.col(second).isin(others))


def chosen(rows: DataFrame, key: str, ids: list) -> DataFrame:
    """Rows of the ids; an id that isn't there is an error."""
    found = rows.where(F.col(key).isin(ids))
    if missing := sorted(set(ids) - {r[0] for r in found.select(key).distinct().collect()}):  # ids that were asked for
        raise KeyError(f"not found: {missing}")
    return found


def due(messages: DataFrame, now: str, limit: int = 10) -> DataFrame:
    """Pending messages whose time has come, oldest first."""
    return messages.where((F.col("status") == "pending") & (F.col("available_at") <= F.lit(now).cast("timestamp"))).orderBy("created_at", "id").limit(limit)


def failed(messages: DataFrame, now: str, most: int = 10) -> DataFrame:
    """A further attempt after a pause that doubles, or the end after the last one."""
    tries = F.col("attempts") + 1
    pause = F.make_interval(secs=C.backoff_seconds(tries))
    again = tries < most
    kept = [c for c in messages.columns if c not in ("attempts", "available_at", "status")]
    return messages.select(*kept, tries.alias("attempts"), F.when(again, F.lit(now).cast("timestamp") + pause).otherwise(F.col("available_at")).alias("available_at"), F.when(again, "pending").otherwise("failed").alias("status"))


def undelivered(messages: DataFrame, inbox: DataFrame) -> DataFrame:
    """Messages that the consumer hasn't had, each once."""
    key = ["consumer", "message_id"]
    return messages.dropDuplicates(key).join(inbox.select(*key).distinct(), key, "left_anti")


def references(raw: DataFrame, datasets: DataFrame, key: str) -> DataFrame:
    """F16: of each raw file the datasets that refer to it, 0 too."""
    counted = datasets.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("n"))
    return raw.join(counted, F.col(key) == F.col("__key"), "left").select(key, F.coalesce("n", F.lit(0)).cast("bigint").alias("references"))


def listed(rows: DataFrame, name: str, newest: bool = False) -> DataFrame:
    """H8: by name and id, or the newest first."""
    return rows.orderBy(F.desc("created_at"), F.desc("id")) if newest else rows.orderBy(name, "id")


def newest(rows: DataFrame, most: int = 6) -> DataFrame:
    """The newest rows, as a report shows them."""
    return listed(rows, "id", newest=True).limit(most)


def checked_sizes(files: DataFrame, size: str, most: int) -> int:
    """bytes of all files; more than the limit is an error."""
    total = files.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    if total > most:
        raise ValueError(f"{total} bytes are more than {most}")
    return total
