"""File sources and sinks over Spark's own readers: delimited text, JSON, Parquet, system-call traces, domain lists."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconframe.functions import columns as C

#: Name of the column for records with another number of fields than the header.
RECORD = "__record"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A text table with a header, all columns strings; empty fields are null, a quote within quotes is doubled.

    Rows with too many fields go, short ones are filled with nulls. Of the rows that don't
    have the header's number of fields, those that one more field changes are short.
    """
    names = spark.read.csv(path, header=True, sep=sep, escape='"').columns
    schema = ", ".join(f"{_quoted(n)} string" for n in names)
    rows = spark.read.csv(path, header=True, sep=sep, escape='"', schema=f"{schema}, {RECORD} string", mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
    longer = F.from_csv(F.concat(F.col(RECORD), F.lit(f"{sep}+")), schema, {"sep": sep, "escape": '"'})
    same = F.lit(True)
    for n in names:
        same = same & longer.getField(n).eqNullSafe(F.col(_quoted(n)))
    return rows.where(F.col(RECORD).isNull() | ~same).select(*[F.nullif(F.col(_quoted(n)), F.lit("")).alias(n) for n in names])


def _leaves(schema: StructType, at: Column | None = None, name: str = "") -> list[Column]:
    out = []
    for f in schema:
        column = F.col(_quoted(f.name)) if at is None else at.getField(f.name)
        full = f"{name}.{f.name}" if name else f.name
        out += _leaves(f.dataType, column, full) if isinstance(f.dataType, StructType) else [column.alias(full)]
    return out


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as columns named by their path with dots."""
    return df.select(*_leaves(df.schema))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """An object a line, else an array of objects or one object, flattened. Objects a line stay splittable; one task reads an array.

    Each line is tried first, so a file of several objects that begins with a brace is read whole.
    """
    lines = [r[0] for r in spark.read.text(path).where(F.trim("value") != "").limit(2).collect()]
    by_line = bool(lines)
    for line in lines:
        try:
            by_line &= isinstance(json.loads(line), dict)
        except ValueError:
            by_line = False
    return flatten(spark.read.json(path, multiLine=not by_line))


def read_calls(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """System-call traces; lines of fewer than seven fields go, of the rest max_rows at most stay.

    Columns: timestamp_ns, cpu_id, thread_id, process_id (null where no integer), process_name,
    syscall, direction, event_ts, entity_id, raw_args (null if empty) and args, the key=value
    pairs by their normalized names.
    """
    parts = spark.read.text(path).select(F.split(F.trim(F.regexp_replace("value", "^\ufeff", "")), r"\s+", 8).alias("p")).where(F.size("p") >= 7)
    if max_rows is not None:
        parts = parts.limit(max_rows)
    at = lambda k: F.get("p", F.lit(k))
    rest = C.blank_to_null(at(7))
    clean = lambda k, _: F.lower(F.regexp_replace(k, "^_+|_+$", ""))
    args = F.transform_values(C.key_values(F.coalesce(rest, F.lit(""))), lambda _, v: C.blank_to_null(v))
    pairs = F.map_entries(args)
    latest = F.map_from_entries(F.transform(F.array_distinct(F.transform(pairs, lambda e: clean(e["key"], None))), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(pairs, lambda e: clean(e["key"], None) == k), 1)["value"].alias("value"))))
    return parts.select(
        at(0).try_cast("bigint").alias("timestamp_ns"),
        at(1).try_cast("bigint").alias("cpu_id"),
        at(2).try_cast("bigint").alias("thread_id"),
        at(3).alias("process_name"),
        at(4).try_cast("bigint").alias("process_id"),
        at(5).alias("syscall"),
        at(6).alias("direction"),
        C.trace_time(at(0)).alias("event_ts"),
        F.concat_ws(":", at(3), at(4)).alias("entity_id"),
        rest.alias("raw_args"),
        latest.alias("args"),
    )


def widen_calls(calls: DataFrame) -> DataFrame:
    """A column for each key that occurs in args, where no column has its name; an empty trace is an error."""
    keys = sorted(r[0] for r in calls.select(F.explode(F.map_keys("args"))).distinct().collect())  # names of keys
    if not keys and calls.isEmpty():
        raise ValueError("the trace has no records")
    return calls.select(*[c for c in calls.columns if c != "args"], *[F.col("args")[k].alias(k) for k in keys if k not in calls.columns])


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """The first token that isn't empty of each line, as column domain."""
    tokens = F.filter(F.transform(F.split("value", ","), lambda t: F.trim(t)), lambda t: t != "")
    return spark.read.text(path).select(F.get(tokens, F.lit(0)).alias("domain")).where(F.col("domain").isNotNull())


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """A folder of text parts, each with the header; nulls are empty."""
    df.write.csv(path, header=True, sep=sep, escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """A folder of parts, an object a line; nulls are written."""
    df.write.json(path, ignoreNullFields=False)
