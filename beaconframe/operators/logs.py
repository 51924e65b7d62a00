"""A store of JSON log lines, one file a service and day: entries, redaction, search and pages by cursor."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconframe.operators import ordered
from beaconframe.session import ship

# fixed values: keys whose values are never shown, and what stands in their place
SENSITIVE = {"access_token", "api_key", "authorization", "cookie", "password", "refresh_token", "secret", "token"}
HIDDEN = "***REDACTED***"
#: Characters of a line that is no JSON object that are kept.
RAW_CHARS = 500
#: The order of entries; a null time comes before all others.
KEYS = ["timestamp", "service", "source_file", "line_number"]
_ENTRY = pa.schema([("timestamp", pa.string()), ("service", pa.string()), ("level", pa.string()), ("function", pa.string()), ("message", pa.string()), ("request", pa.string()), ("error", pa.string()), ("context", pa.string()), ("is_valid", pa.bool_()), ("raw_line", pa.string())])


def redact(value: object) -> object:
    """The value without what is kept under sensitive keys, in any case and depth."""
    if isinstance(value, dict):
        return {k: HIDDEN if k.lower() in SENSITIVE else redact(v) for k, v in value.items()}
    return [redact(v) for v in value] if isinstance(value, list) else value


def entry(line: str, service: str) -> tuple:
    """The fields of a line, with defaults; a line that is no JSON object is a warning that shows it."""
    try:
        found = json.loads(line)
        if not isinstance(found, dict):
            raise ValueError("not an object")
    except (ValueError, RecursionError) as error:
        return None, service, "WARNING", "log_parser", "Invalid JSONL record", "{}", json.dumps({"type": "InvalidJsonLine", "message": str(error)}), "{}", False, line[:RAW_CHARS]
    found = redact(found)
    text = lambda name, otherwise: str(found[name]) if found.get(name) else otherwise
    part = lambda name: json.dumps(found[name] if isinstance(found.get(name), dict) else {}, ensure_ascii=False)
    error = None if found.get("error") is None else json.dumps(found["error"], ensure_ascii=False)
    return text("timestamp", None), text("service", service), text("level", "INFO"), text("function", "unknown"), text("message", ""), part("request"), error, part("context"), True, None


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows line, service and others, which are carried."""
    for batch in batches:
        rows = [entry(line, service) for line, service in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        made = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_ENTRY), _ENTRY, strict=True)]
        yield pa.RecordBatch.from_arrays([*made, *batch.columns[2:]], names=[*_ENTRY.names, *batch.schema.names[2:]])


def _globs(spark: SparkSession, root: str) -> list[str]:
    """Patterns of the store's files that match some: those of a service and day, and the parts that write_logs makes."""
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return [p for p in (f"{root}/*/*.json.log", f"{root}/service=*/day=*/*.json") if fs.globStatus(path(p))]


def _unescaped(s: Column) -> Column:
    return F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))


def _service(path: Column) -> Column:
    """The folder's name, or what the sink put into it, where it is escaped."""
    written = F.regexp_extract(path, r"/service=([^/]+)/day=[^/]+/[^/]+$", 1)
    return F.when(written != "", _unescaped(written)).otherwise(F.element_at(F.split(path, "/"), -2))


def read_logs(spark: SparkSession, root: str, services: list[str] | None = None, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Entries of the files root/service/service-day.json.log and of what write_logs wrote, with source_file and line_number.

    Only files of the services and days asked for are read; a file whose path has no day is
    read always. Blank lines are no entries, but count as lines.
    """
    ship(spark)
    kinds = "timestamp string, service string, level string, function string, message string, request string, error string, context string, is_valid boolean, raw_line string"
    paths = []
    if globs := _globs(spark, root):
        day = F.try_to_date(F.regexp_extract("path", r"(?:-|/day=)(\d{4}-\d{2}-\d{2})(?:\.json\.log|/[^/]+)$", 1), "yyyy-MM-dd")
        listed = spark.read.format("binaryFile").load(globs).select("path").withColumn("day", day).withColumn("service", _service(F.col("path")))
        wanted = listed.where(F.endswith("path", F.lit(".json")) | F.contains(F.element_at(F.split("path", "/"), -1), F.concat("service", F.lit("-"))))
        if services:
            wanted = wanted.where(F.col("service").isin(services))
        for bound, later in ((date_from, True), (date_to, False)):
            if bound:
                limit = F.lit(date.fromisoformat(bound))
                wanted = wanted.where(F.col("day").isNull() | (F.col("day") >= limit if later else F.col("day") <= limit))
        paths = [r["path"] for r in wanted.orderBy("day", "path").collect()]  # names of files
    if not paths:
        return spark.createDataFrame([], f"{kinds}, source_file string, line_number bigint")
    lines = spark.read.text(paths).select(F.trim("value").alias("line"), F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    numbered = ordered.rank(lines, ["source_file"], ["block", "at"], "line_number").where("line <> ''")
    shaped = numbered.select("line", _service(_unescaped(F.col("source_file"))).alias("service"), "source_file", "line_number")
    return shaped.mapInArrow(_entries, f"{kinds}, source_file string, line_number bigint")


def list_services(spark: SparkSession, root: str) -> list[str]:
    """Names of the services that have logs."""
    if not (globs := _globs(spark, root)):
        return []
    found = spark.read.format("binaryFile").load(globs).select(_service(F.col("path")).alias("s"))
    return [r["s"] for r in found.distinct().orderBy("s").collect()]  # names of services


@dataclass
class Search:
    """What entries must have; texts are found within the field, in any case."""

    services: list[str] | None = None
    level: str | None = None
    function: str | None = None
    message: str | None = None
    error_text: str | None = None
    search: str | None = None
    date_from: str | None = None
    date_to: str | None = None
    time_from: str | None = None
    time_to: str | None = None


def matching(entries: DataFrame, wanted: Search) -> DataFrame:
    """A time that is null or can't be read passes bounds of the day and fails those of the time of day."""
    ok = F.lit(True)
    if wanted.services:
        ok &= F.col("service").isin(wanted.services)
    if wanted.level:
        ok &= F.lower("level") == wanted.level.lower()
    blob = F.lower(F.concat_ws(" ", "service", "level", "function", "message", F.coalesce("error", F.lit(""))))
    for column, text in ((F.lower("function"), wanted.function), (F.lower("message"), wanted.message), (F.lower(F.coalesce("error", F.lit(""))), wanted.error_text), (blob, wanted.search)):
        if text:
            ok &= column.contains(text.lower())
    time = F.col("timestamp").try_cast("timestamp") if dict(entries.dtypes)["timestamp"] == "string" else F.col("timestamp").cast("timestamp")
    if wanted.date_from:
        ok &= time.isNull() | (F.to_date(time) >= F.lit(date.fromisoformat(wanted.date_from)))
    if wanted.date_to:
        ok &= time.isNull() | (F.to_date(time) <= F.lit(date.fromisoformat(wanted.date_to)))
    clock = F.date_format(time, "HH:mm:ss.SSSSSS")
    whole = lambda t: (t if len(t) > 5 else f"{t}:00") + ("" if "." in t else ".000000")
    if wanted.time_from:
        ok &= F.coalesce(clock >= whole(wanted.time_from), F.lit(False))
    if wanted.time_to:
        ok &= F.coalesce(clock <= whole(wanted.time_to), F.lit(False))
    return entries.where(ok)


def cursor_of(position: dict) -> str:
    """H7: a page's end as an opaque text."""
    return base64.urlsafe_b64encode(json.dumps({k: position[k] for k in KEYS}).encode()).decode()


def position_of(cursor: str | None) -> list | None:
    """H7: the four keys of a cursor; a text that isn't one is as none."""
    try:
        found = json.loads(base64.urlsafe_b64decode(f"{cursor}===")) if cursor else None
        return [str(found["timestamp"] or ""), str(found["service"]), str(found["source_file"]), int(found["line_number"])] if found else None
    except (ValueError, KeyError, TypeError):
        return None


def after(entries: DataFrame, position: list | None, descending: bool = False) -> DataFrame:
    """The entries behind a position in the order of KEYS, with a null time as an empty one."""
    if position is None:
        return entries
    mine = F.struct(F.coalesce(F.col("timestamp").cast("string"), F.lit("")).alias("timestamp"), *KEYS[1:3], F.col(KEYS[3]).cast("bigint").alias(KEYS[3]))
    its = F.struct(*[F.lit(v).cast("bigint" if k == KEYS[3] else "string").alias(k) for k, v in zip(KEYS, position, strict=True)])
    return entries.where(mine < its if descending else mine > its)


def page(entries: DataFrame, size: int = 50, cursor: str | None = None, descending: bool = True) -> dict:
    """One page, the cursor of the next, and how many of its lines were invalid; size is 1 to 200."""
    if not 1 <= size <= 200:
        raise ValueError("a page has 1 to 200 entries")
    keys = [F.coalesce(F.col("timestamp").cast("string"), F.lit("")), *[F.col(k) for k in KEYS[1:]]]
    rows = after(entries, position_of(cursor), descending).orderBy(*[k.desc() if descending else k.asc() for k in keys]).limit(size + 1).collect()
    items = [r.asDict() for r in rows[:size]]
    return {"items": items, "has_more": len(rows) > size, "next_cursor": cursor_of(items[-1]) if len(rows) > size else None, "invalid_rows": sum(not r["is_valid"] for r in items)}


def write_logs(entries: DataFrame, root: str) -> None:
    """Entries as JSON lines in folders of service and day, which read_logs reads.

    request, error and context are JSON text and are written as what they say, what is no
    JSON as null.
    """
    time = F.col("timestamp").try_cast("timestamp") if dict(entries.dtypes)["timestamp"] == "string" else F.col("timestamp")
    said = {c: F.try_parse_json(c) for c in ("request", "error", "context") if dict(entries.dtypes).get(c) == "string"}
    dated = entries.withColumn("day", F.date_format(time, "yyyy-MM-dd"))
    dated.withColumns(said).write.mode("append").partitionBy("service", "day").json(root)


def day_of(name: str) -> str | None:
    """The day in a log file's name."""
    found = re.search(r"(\d{4}-\d{2}-\d{2})\.json\.log$", name)
    return found[1] if found else None
