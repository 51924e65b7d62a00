"""Rows of a file with an overlay of changes: typed cells, pages and saving."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from beaconframe.operators import core, ordered
from beaconframe.session import scratch
from beaconframe.sources import formats

INDEX = "row_index"
#: Formats that can be read but not saved.
READ_ONLY = {"pcap", "sc"}
# fixed values: words for true and false, and the types that a column may have with Spark's name
YES, NO = ["true", "1", "yes"], ["false", "0", "no"]
TYPES = {"int": "bigint", "float": "double", "bool": "boolean", "datetime": "timestamp", "date": "date", "string": "string"}


class EditorError(ValueError):
    """A change that the rows can't take."""


def open_rows(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A file's rows, numbered from 0 in a column before the others; nested values are an error."""
    rows = formats.read(spark, path, sheet)
    if nested := [f.name for f in rows.schema if isinstance(f.dataType, (ArrayType, MapType, StructType)) and formats.detect_format(spark, path) != "pcap"]:
        raise EditorError(f"nested columns: {nested}")
    return ordered.ordinal(rows, INDEX)


def type_name(column: Column) -> Column:
    """The type that a text spells."""
    t = F.trim(column)
    return (
        F.when(column.isNull() | (t == ""), F.lit(None))
        .when(F.lower(t).isin("true", "false"), "bool")
        .when(t.rlike(r"^-?\d+$"), "int")
        .when(t.try_cast("double").isNotNull(), "float")
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}$") & t.try_cast("date").isNotNull(), "date")
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}[Tt ]") & t.try_cast("timestamp").isNotNull(), "datetime")
        .otherwise("string")
    )


def column_types(rows: DataFrame) -> dict[str, str]:
    """Of each column the type of its first value that isn't null; string if there is none. A declared type counts as it is."""
    names = {"byte": "int", "short": "int", "integer": "int", "long": "int", "float": "float", "double": "float", "decimal": "float", "boolean": "bool", "date": "date", "timestamp": "datetime", "timestamp_ntz": "datetime"}
    columns = [c for c in rows.columns if c != INDEX]
    first = rows.agg(*[F.min_by(type_name(F.col(f"`{c}`").cast("string")), F.when(type_name(F.col(f"`{c}`").cast("string")).isNotNull(), F.col(INDEX))).alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return {c: names.get(rows.schema[c].dataType.typeName()) or first[f"c{k}"] or "string" for k, c in enumerate(columns)}


def coerced(value: Column, kind: str) -> Column:
    """A text as a type; blank is null, and so is what can't be read."""
    if kind not in TYPES:
        raise EditorError(f"no type {kind!r}")
    text = F.nullif(value.cast("string"), F.lit(""))
    if kind == "bool":
        return F.when(F.lower(F.trim(text)).isin(YES), F.lit(True)).when(F.lower(F.trim(text)).isin(NO), F.lit(False))
    return text.try_cast(TYPES[kind])


def lenient(value: Column, kind: str) -> Column:
    """As text in the form of the type, or as it was where it can't be read."""
    return F.coalesce(coerced(value, kind).cast("string"), F.nullif(value.cast("string"), F.lit("")))


def check_cells(patches: DataFrame, types: dict[str, str]) -> None:
    """An error for the first patch (row_index, column, value) that its column can't take."""
    if unknown := [r[0] for r in patches.select("column").distinct().where(~F.col("column").isin(list(types))).limit(5).collect()]:
        raise EditorError(f"no columns {unknown}")
    bad = F.lit(False)
    for c, kind in types.items():
        bad |= (F.col("column") == c) & F.nullif(F.col("value"), F.lit("")).isNotNull() & coerced(F.col("value"), kind).isNull()
    if (first := patches.where(bad).orderBy(INDEX, "column").first()) is not None:
        raise EditorError(f"{first['value']!r} is no {types[first['column']]} ({first['column']}, row {first[INDEX]})")


@dataclass
class Session:
    """Base rows with patches (row_index, column, value, seq), deleted rows and hidden columns."""

    base: DataFrame
    patches: DataFrame
    deleted: DataFrame
    hidden: list[str] = field(default_factory=list)

    @staticmethod
    def of(base: DataFrame) -> Session:
        spark = base.sparkSession
        return Session(base, spark.createDataFrame([], f"{INDEX} bigint, column string, value string, seq bigint"), spark.createDataFrame([], f"{INDEX} bigint"))

    def columns(self) -> list[str]:
        return [c for c in self.base.columns if c not in self.hidden]

    def hide(self, names: list[str]) -> Session:
        """Without some columns; one at least must stay."""
        hidden = [*self.hidden, *names]
        if unknown := [n for n in names if n not in self.base.columns or n == INDEX]:
            raise EditorError(f"no columns {unknown}")
        if len(set(hidden)) >= len(self.base.columns) - 1:
            raise EditorError("a column must stay")
        return Session(self.base, self.patches, self.deleted, hidden)

    def rows(self) -> DataFrame:
        """What is to be seen."""
        patched = [r[0] for r in self.patches.select("column").distinct().collect()]  # names of columns
        return core.overlay(self.base, INDEX, self.patches, self.deleted, [c for c in patched if c in self.base.columns]).select(*[F.col(f"`{c}`") for c in self.columns()])

    def state(self, size: int = 50) -> dict:
        """rows to be seen, changed cells, deleted rows and pages."""
        rows = self.rows().count()
        return {"rows": rows, "pending_cells": self.patches.select(INDEX, "column").distinct().count(), "deleted_rows": self.deleted.distinct().count(), "pages": max(1, math.ceil(rows / size))}

    def page(self, number: int, size: int = 50) -> list[dict]:
        """H5: rows of a page, from 1; a size beyond 1 to 200 or a page that isn't there is an error."""
        if not 1 <= size <= 200:
            raise EditorError("a page has 1 to 200 rows")
        if not 1 <= number <= self.state(size)["pages"]:
            raise EditorError(f"there is no page {number}")
        return [r.asDict() for r in jsonable(self.rows().orderBy(INDEX).offset((number - 1) * size).limit(size)).collect()]


def jsonable(rows: DataFrame) -> DataFrame:
    """Dates and times as ISO text, in UTC where they have no zone."""
    out = []
    for f in rows.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        out.append((F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'") if kind.startswith("timestamp") else c.cast("string") if kind == "date" else c).alias(f.name))
    return rows.select(*out)


def save(session: Session, path: str, format_: str) -> None:
    """The rows in their order as one file in the place of `path`: written apart, then renamed. One task writes it, as a file is one."""
    if format_ in READ_ONLY:
        raise EditorError(f"{format_} can't be saved")
    rows, spark = session.rows(), session.base.sparkSession
    typed = rows.select(INDEX, *[F.col(f"`{c}`").try_cast(session.base.schema[c].dataType).alias(c) for c in rows.columns if c != INDEX])
    sorted_ = typed.orderBy(INDEX).drop(INDEX)
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(hadoop)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.saving")
    if format_ == "xlsx":
        head = sorted_.columns
        data = formats.xlsx_bytes({"Sheet1": (head, (list(r) for r in sorted_.toLocalIterator()))})
        out = fs.create(beside, True)
        out.write(bytearray(data))
        out.close()
    else:
        folder = scratch(spark, "saving")
        one = sorted_.coalesce(1).write
        {"csv": lambda: one.csv(folder, header=True, escape='"'), "res": lambda: one.csv(folder, header=True, escape='"'), "tsv": lambda: one.csv(folder, header=True, sep="\t", escape='"'), "json": lambda: one.json(folder, ignoreNullFields=False), "parquet": lambda: one.parquet(folder)}[format_]()
        made = [f.getPath() for f in jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(hadoop).listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if f.getPath().getName().startswith("part-")]
        source = made[0].getFileSystem(hadoop)
        jvm.org.apache.hadoop.fs.FileUtil.copy(source, made[0], fs, beside, False, hadoop)
        source.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"{path} can't be replaced")


def as_json_array(rows: DataFrame) -> str:
    """Rows as one JSON array, for small tables: nulls are written."""
    return json.dumps([r.asDict() for r in jsonable(rows).collect()], ensure_ascii=False)
