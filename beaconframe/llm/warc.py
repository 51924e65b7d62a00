"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id and payload digest. The ranges' bounds are quantiles of
the records that a hash of both draws, and their number follows from the payloads' size
alone, so they depend on the rows and on nothing else. Each shard is written as gzip
members, one a record, and a new file begins when the compressed size reaches
`roll_bytes`. Files are written under temporary names of the task attempt; when all tasks
have ended, tasks rename the winners' files and the driver puts the manifest in place, by
rename too. What the manifest does not list was never committed. Headers and digests are
made anew from the payload, so equal rows give equal bytes, whatever their partitions.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconframe.session import cut, scratch, ship, table

#: Payloads of fewer bytes are always written whole.
LEAST_REVISIT = 1000
ROLL_BYTES = 256 << 20
#: Payload bytes of a shard, about, and the most shards; DRAWN records a shard are drawn for the bounds, which the driver sorts.
SHARD_BYTES, MOST_SHARDS, DRAWN = 16 << 20, 20_000, 20
DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6f6a1c52-3f0b-5a3c-9a55-0d6c1a0f7b11")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {digest}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _target(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "about:blank")


def info(file: str) -> bytes:
    """The warcinfo record at the head of a file."""
    block = b"format: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, file)}>", f"WARC-Date: {DATE}", f"WARC-Filename: {file}", f"WARC-Block-Digest: {_sha1(block)}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(page_id: object, url: str | None, payload: bytes, refers_to: tuple | None = None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of the page `refers_to` (its id and url)."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    again = []
    if refers_to is not None:
        again = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to[0], digest)}", f"WARC-Refers-To-Target-URI: {_target(refers_to[1])}", f"WARC-Refers-To-Date: {DATE}", f"Page-Refers-To: {refers_to[0]}"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_target(url)}",
        *again,
        *([f"Page-ID: {page_id}"] if page_id is not None else []),
        f"WARC-Payload-Digest: {_sha1(payload)}",
        f"WARC-Block-Digest: {_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Shard:
    """A file being written under its temporary name."""

    def __init__(self, folder: str, shard: int, number: int, attempt: str) -> None:
        self.final = f"part-{shard:06d}-{number:06d}.warc.gz"
        self.temporary = f"_temporary/{attempt}/{self.final}"
        self.fs, base = _open(folder)
        self.fs.create_dir(f"{base}/_temporary/{attempt}", recursive=True)
        self.out = self.fs.open_output_stream(f"{base}/{self.temporary}", compression=None)
        self.bytes = self.records = 0
        self.sha256 = hashlib.sha256()
        self._member(info(self.final))

    def write(self, data: bytes) -> None:
        self._member(data)
        self.records += 1

    def _member(self, data: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.out.write(member)
        self.sha256.update(member)
        self.bytes += len(member)

    def close(self) -> tuple:
        self.out.close()
        return self.temporary, self.final, self.records, self.bytes, self.sha256.hexdigest()


_FILES = pa.schema([("temporary", pa.string()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows: shard, page id, mark, digest, refers_to, url, html; a shard's rows adjoin. A page's marks (digests that are revisits, with the url of what they refer to) come before it."""
    from pyspark import TaskContext

    context = TaskContext.get()
    attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
    out, of, number, done = None, None, 0, []
    now, marks = object(), {}
    for batch in batches:
        shards, ids, marked, digests, refers, urls = (batch.column(k).to_pylist() for k in range(6))
        html = batch.column(6)
        for k, page in enumerate(ids):
            if page != now or shards[k] != of:
                now, marks = page, {}
            if shards[k] != of:
                if out is not None:
                    done.append(out.close())
                out, of, number = None, shards[k], 0
            if marked[k] == 0:
                marks[digests[k]] = refers[k], urls[k]
                continue
            payload = html[k].as_buffer().to_pybytes() if html[k].is_valid else b""
            if out is None:
                out = _Shard(folder, of, number, attempt)
            out.write(record(page, urls[k], payload, marks.get(digests[k])))
            if out.bytes >= roll_bytes:
                done.append(out.close())
                out, number = None, number + 1
    if out is not None:
        done.append(out.close())
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _FILES, strict=True)], schema=_FILES)


def _renamed(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Gives files their names; a repeated attempt finds those that have them."""
    fs, base = _open(folder)
    for batch in batches:
        for temporary, final, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if fs.get_file_info(f"{base}/{temporary}").type != pafs.FileType.NotFound:
                fs.move(f"{base}/{temporary}", f"{base}/{final}")
            elif fs.get_file_info(f"{base}/{final}").size != size:
                raise OSError(f"{final} is lost")
        yield batch.select([1])


def _sharded(rows: DataFrame, placed: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """placed with a column shard before the others, the number of bounds that its (id, digest) reaches, and how many shards there are."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).alias("bytes")).first()
    shards = max(1, min(MOST_SHARDS, -(-size["bytes"] // shard_bytes)))
    if shards == 1:
        return placed.select(F.lit(0).alias("shard"), "*"), 1
    draw = F.pmod(F.xxhash64("id", "digest"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, DRAWN * shards / size["n"])))
    key = F.struct("id", "digest")
    drawn = [r[0] for r in rows.where(draw).select(key.alias("k")).orderBy("k").collect()]  # about DRAWN * shards of them
    bounds = sorted({(k * len(drawn)) // shards for k in range(1, shards)} - {0})
    kind = f"array<struct<id: {rows.schema['id'].dataType.simpleString()}, digest: string>>"
    listed = placed.sparkSession.createDataFrame([([tuple(drawn[k]) for k in bounds],)], f"bounds {kind}")
    jump = 1 << (MOST_SHARDS - 1).bit_length()
    steps = F.array(*[F.lit(jump >> k) for k in range(1, jump.bit_length())])
    reaches = lambda at: F.coalesce(F.get("bounds", at - 1) <= key, F.lit(False))
    search = F.aggregate(steps, F.lit(0), lambda low, step: F.when(reaches(low + step), low + step).otherwise(low))
    return placed.crossJoin(F.broadcast(listed)).select(search.alias("shard"), *placed.columns), shards  # one row


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> dict:
    """Writes a record for each row and commits; returns the manifest (also at folder/manifest.json).

    The payload is the html in UTF-8, a null one empty. Of rows with equal payloads of
    LEAST_REVISIT bytes or more, those with the largest key are responses and the rest
    revisit it; rows with a null key are responses. Repeated rows are records of their
    own; other columns are ignored; no rows give a manifest without files. Records are in
    the order of key (null first), payload digest and url; files and manifest are the same
    for the same rows in any order. A folder that holds anything is refused.
    """
    spark = pages.sparkSession
    ship(spark)
    fs, base = _open(folder)
    if fs.get_file_info(base).type != pafs.FileType.NotFound and fs.get_file_info(pafs.FileSelector(base)):
        raise FileExistsError(f"{folder} is not empty")
    body = F.col(html).cast("string")
    rows = pages.select(F.col(key).alias("id"), F.sha1(F.coalesce(body, F.lit("")).cast("binary")).alias("digest"), F.col(url).cast("string").alias("url"), body.alias("html"))
    large = rows.where(F.col("id").isNotNull() & (F.octet_length("html") >= LEAST_REVISIT)).select("id", "digest", "url")
    groups = large.groupBy("digest").agg(F.max(F.struct("id", "url")).alias("last"), F.min("id").alias("first")).where("first <> last.id").select("digest", "last")
    groups = cut(groups)  # with a shuffle of its own below the join, a hot digest can be split there
    none = F.lit(None).cast(rows.schema["id"].dataType)
    marks = large.join(groups, "digest").where(F.col("id") != F.col("last.id")).select("id", F.lit(0).alias("mark"), "digest", F.col("last.id").alias("refers_to"), F.col("last.url").alias("url"), F.lit(None).cast("string").alias("html"))
    whole = rows.select("id", F.lit(1).alias("mark"), "digest", none.alias("refers_to"), "url", "html")
    placed, shards = _sharded(rows, whole.unionByName(marks), shard_bytes)
    sorted_ = placed.repartition(shards, "shard").sortWithinPartitions("shard", "id", "digest", "mark", "url")
    written = sorted_.mapInArrow(lambda it: _write(it, folder, roll_bytes), "temporary string, file string, records bigint, bytes bigint, sha256 string").collect()  # a row for each file
    files = sorted(written, key=lambda r: r.file)
    if files:
        names = spark.createDataFrame([(r.temporary, r.file, r.bytes) for r in files], "temporary string, file string, bytes bigint").repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism)))
        names.mapInArrow(lambda it: _renamed(it, folder), "file string").collect()
    manifest = {"files": [{k: r[k] for k in ("file", "records", "bytes", "sha256")} for r in files]}
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/manifest.json.tmp") as out:
        out.write(json.dumps(manifest, sort_keys=True).encode())
    fs.move(f"{base}/manifest.json.tmp", f"{base}/manifest.json")
    if fs.get_file_info(f"{base}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{base}/_temporary")
    return manifest


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped WARC file, in order; memory holds one record."""
    with gzip.GzipFile(fileobj=stream) as plain, io.BufferedReader(plain, 1 << 18) as data:
        while version := data.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            headers = {}
            while (line := data.readline().rstrip(b"\r\n")):
                name, _, value = line.partition(b":")
                headers[name.decode()] = value.strip().decode()
            block = data.read(int(headers["Content-Length"]))
            if len(block) != int(headers["Content-Length"]) or data.read(4) != b"\r\n\r\n":
                raise ValueError("a record is cut short")
            yield headers, block


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("file", pa.string())])


class _Hashed(io.RawIOBase):
    """A stream that hashes and counts what is read from it."""

    def __init__(self, stream) -> None:
        super().__init__()
        self.stream, self.sha256, self.bytes = stream, hashlib.sha256(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        data = self.stream.read(len(target))
        target[: len(data)] = data
        self.sha256.update(data)
        self.bytes += len(data)
        return len(data)


def _int(value: str | None) -> int | None:
    return None if value is None else int(value)


def _read(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    """Rows of the manifest: file, records, bytes, sha256."""
    fs, base = _open(folder)
    out: list[tuple] = []
    held = 0
    for batch in batches:
        for file, count, size_, sha256 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            seen = 0
            with fs.open_input_stream(f"{base}/{file}", compression=None) as stream:
                hashed = _Hashed(stream)
                for h, block in records(hashed):
                    if _sha1(block) != h["WARC-Block-Digest"]:
                        raise ValueError(f"a block digest differs in {file}, {h['WARC-Record-ID']}")
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    seen += 1
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if h["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"a payload digest differs in {file}, {h['WARC-Record-ID']}")
                    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length:")).split(b":")[1])
                    out.append((_int(h.get("Page-ID")), h["WARC-Target-URI"], h["WARC-Type"], _int(h.get("Page-Refers-To")), size, digest, payload if payloads and h["WARC-Type"] == "response" else None, file))
                    held += len(payload) if payloads else 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _READ, strict=True)], schema=_READ)
                        out, held = [], 0
            if (seen, hashed.bytes, hashed.sha256.hexdigest()) != (count, size_, sha256):
                raise ValueError(f"{file} is not as the manifest says: {seen} of {count} records, {hashed.bytes} of {size_} bytes")
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _READ, strict=True)], schema=_READ)


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the files in folder's manifest: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, file.

    payload is null for revisits (and everywhere if payloads is false). Digests are checked,
    and each file's records, bytes and SHA-256 against the manifest: what was cut short,
    changed or lost raises an error. No files give no rows.
    """
    ship(spark)
    fs, base = _open(folder)
    with fs.open_input_stream(f"{base}/manifest.json") as f:
        files = [(x["file"], x["records"], x["bytes"], x["sha256"]) for x in json.loads(f.read())["files"]]
    listed = spark.createDataFrame(files, "file string, records bigint, bytes bigint, sha256 string").repartition(max(1, min(len(files), 10_000)))
    return listed.mapInArrow(lambda it: _read(it, folder, payloads), "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, file string")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: writes `pages`, whole table, as WARC files and reads the records back from them."""
    folder = scratch(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(octet_length(encode(html)), 0) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN g.keep IS NULL OR p.page_id IS NULL OR g.keep = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.keep <> p.page_id THEN g.keep END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= {LEAST_REVISIT}
"""
