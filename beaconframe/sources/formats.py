"""Which format a file has, its header, and one reader for all; spreadsheets and archives by the standard library on the executors."""

from __future__ import annotations

import bz2
import csv
import gzip
import io
import lzma
import posixpath
import re
import tarfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconframe.session import ship
from beaconframe.sources import files, packets

# fixed values: suffixes of data files and of archives, and the first bytes of packet captures
FORMATS = {".csv": "csv", ".tsv": "tsv", ".parquet": "parquet", ".xlsx": "xlsx", ".json": "json", ".jsonl": "json", ".ndjson": "json", ".pcap": "pcap", ".pcapng": "pcap", ".res": "res", ".sc": "sc"}
ARCHIVES = [".tar.gz", ".tar.bz2", ".tar.xz", ".tgz", ".tbz2", ".txz", ".zip", ".tar", ".gz", ".bz2", ".xz"]
CAPTURES = {b"\xd4\xc3\xb2\xa1", b"\xa1\xb2\xc3\xd4", b"\x0a\x0d\x0d\x0a"}
#: Characters of a text by which its delimiter is told.
HEAD = 4096


class UnknownFormat(ValueError):
    """A file of no format that can be read."""


def name_of(path: str) -> str:
    return posixpath.basename(path.rstrip("/"))


def stem_of(path: str) -> str:
    return posixpath.splitext(name_of(path))[0]


def suffix_of(path: str) -> str:
    return posixpath.splitext(name_of(path))[1].lower()


def detect_format(spark: SparkSession, path: str) -> str:
    """A1: by the suffix, else by the first bytes of a capture."""
    found = FORMATS.get(suffix_of(path))
    if found is None:
        try:
            head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 4).alias("h")).first()
        except Exception as error:
            raise UnknownFormat(f"no format of {name_of(path)!r} is known") from error
        found = "pcap" if head is not None and bytes(head["h"]) in CAPTURES else None
    if found is None:
        raise UnknownFormat(f"no format of {name_of(path)!r} is known")
    return found


def is_domain_list(path: str) -> bool:
    """By its name."""
    return bool(re.search(r"_domains\.(csv|tsv)$", name_of(path).lower()))


def sniff_delimiter(spark: SparkSession, path: str, format_: str = "csv") -> str:
    """A2: comma, semicolon or tab by the head of the text; a comma if it can't be told. An empty file is an error."""
    if format_ == "tsv":
        return "\t"
    lines = [r[0] for r in spark.read.text(path).limit(200).collect()]
    head = "\n".join(lines)[:HEAD].lstrip("﻿")
    if not head.strip():
        raise ValueError(f"{name_of(path)} is empty")
    try:
        return csv.Sniffer().sniff(head, delimiters=",;\t").delimiter
    except csv.Error:
        return ","


def read(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Any format; delimited text and spreadsheets as strings, traces with a column for each key."""
    format_ = detect_format(spark, path)
    if is_domain_list(path):
        return files.read_domains(spark, path)
    if format_ in ("csv", "tsv", "res"):
        return files.read_delimited(spark, path, sniff_delimiter(spark, path, format_))
    if format_ == "parquet":
        return spark.read.parquet(path)
    if format_ == "json":
        return files.read_json(spark, path)
    if format_ == "xlsx":
        return read_xlsx(spark, path, sheet)
    if format_ == "sc":
        return files.widen_calls(files.read_calls(spark, path))
    return packets.read_packets(spark, path)


def headers(spark: SparkSession, path: str) -> list[str]:
    """A10: the column names, with no more read than the format needs."""
    return read(spark, path).columns


def skipped_rows(spark: SparkSession, path: str, rows: int) -> int:
    """Lines of a delimited text that gave no row, about: line breaks within quotes count as lines."""
    return max(0, spark.read.text(path).where(F.trim("value") != "").count() - rows - 1)


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def xlsx_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """A5: cells of a sheet (the first one if no name is given) as text, a row at a time."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_NS}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        listed = [(s.get("name"), targets[s.get(f"{_REL}id")]) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet")]
        target = next((t for n, t in listed if sheet is None or n == sheet), None)
        if target is None:
            raise ValueError(f"no sheet {sheet!r}")
        with z.open(posixpath.normpath(posixpath.join("xl", target)) if not target.startswith("/") else target[1:]) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_NS}row":
                    continue
                cells: list[str | None] = []
                for c in row.findall(f"{_NS}c"):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    value, kind = c.find(f"{_NS}v"), c.get("t")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
                    elif value is not None and value.text is not None:
                        cells[at] = shared[int(value.text)] if kind == "s" else {"1": "true", "0": "false"}.get(value.text, value.text) if kind == "b" else value.text
                yield cells
                row.clear()


def _sheets(batches: Iterator[pa.RecordBatch], sheet: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            held: list[list[str | None]] = []
            first = 0
            for cells in xlsx_rows(data.as_py(), sheet):
                held.append(cells)
                if len(held) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(range(first, first + 1000), pa.int64()), pa.array(held, pa.list_(pa.string()))], names=["row_index", "cells"])
                    held, first = [], first + 1000
            yield pa.RecordBatch.from_arrays([pa.array(range(first, first + len(held)), pa.int64()), pa.array(held, pa.list_(pa.string()))], names=["row_index", "cells"])


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A5: a sheet with a header in its first row, all columns strings. One task reads one file, as its parts can't be read apart."""
    ship(spark)
    rows = spark.read.format("binaryFile").load(path).select("content").mapInArrow(lambda it: _sheets(it, sheet), "row_index bigint, cells array<string>")
    head = rows.where("row_index = 0").first()
    names = dedup_headers(head["cells"]) if head is not None else []
    return rows.where("row_index > 0").select(*[F.nullif(F.get("cells", F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)])


def dedup_headers(names: list[str | None]) -> list[str]:
    """Blank names by their place, repeated ones numbered from the second on."""
    seen: dict[str, int] = {}
    out = []
    for k, name in enumerate(names, 1):
        name = (name or "").strip() or f"column_{k}"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def xlsx_bytes(sheets: dict[str, tuple[list[str], Iterator[list[object]]]]) -> bytes:
    """A spreadsheet of named sheets (columns, rows); text cells are written in place. A sheet has no more than 1,048,576 rows."""
    out = io.BytesIO()
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        z.writestr("[Content_Types].xml", head + '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1)) + "</Types>")
        z.writestr("_rels/.rels", head + '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", head + f'<workbook xmlns="{_NS[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>' + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", head + '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1)) + "</Relationships>")
        for k, n in enumerate(names, 1):
            columns, rows = sheets[n]
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                f.write((head + f'<worksheet xmlns="{_NS[1:-1]}"><sheetData>').encode())
                for row in ([*columns], *rows):
                    f.write(("<row>" + "".join(_cell(v) for v in row) + "</row>").encode("utf-8", "replace"))
                f.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _cell(v: object) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f"<c><v>{v}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def detect_archive(path: str) -> str | None:
    """The archive's suffix, the longest that fits; null for other files."""
    name = name_of(path).lower()
    return max((s for s in ARCHIVES if name.endswith(s)), key=len, default=None)


def safe_path(name: str) -> str:
    """A relative path with plain slashes; one that is absolute or leads out of its folder is an error."""
    clean = posixpath.normpath(name.replace("\\", "/").strip())
    if clean in (".", "") or clean.startswith(("/", "../")) or clean == ".." or re.match(r"^[A-Za-z]:", clean):
        raise ValueError(f"unsafe path {name!r}")
    return clean


def members(name: str, data: bytes) -> Iterator[tuple[str, bytes]]:
    """Path and content of each file in an archive; links and unsafe paths are errors."""
    kind = detect_archive(name)
    if kind is None:
        raise UnknownFormat(f"{name!r} is no archive")
    if kind == ".zip":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for entry in z.infolist():
                if not entry.is_dir():
                    yield safe_path(entry.filename), z.read(entry)
    elif "tar" in kind or kind in (".tgz", ".tbz2", ".txz"):
        with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
            for entry in t:
                if entry.isdir():
                    continue
                if not entry.isfile():
                    raise ValueError(f"{entry.name!r} is no plain file")
                yield safe_path(entry.name), t.extractfile(entry).read()
    else:
        yield safe_path(name_of(name)[: -len(kind)]), {".gz": gzip.decompress, ".bz2": bz2.decompress, ".xz": lzma.decompress}[kind](data)


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for member, content in members(path, data.as_py()):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([member]), pa.array([len(content)], pa.int64()), pa.array([content], pa.binary())], names=["archive", "member", "length", "content"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive, member, length, content of all files in the archives; one task opens one archive."""
    ship(spark)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    kinds = "|".join(re.escape(s) for s in ARCHIVES)
    return found.where(F.lower("path").rlike(f"({kinds})$")).select("path", "content").mapInArrow(_expanded, "archive string, member string, length bigint, content binary")


def list_files(spark: SparkSession, path: str, archives: bool = False) -> DataFrame:
    """Name, relative path, size and time of the files of known formats (or of the archives) under a folder, by name; contents aren't read."""
    suffixes = ARCHIVES if archives else list(FORMATS)
    pattern = "(" + "|".join(re.escape(s) for s in suffixes) + ")$"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    return found.where(F.lower("path").rlike(pattern)).select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("changed")).orderBy("name", "path")
