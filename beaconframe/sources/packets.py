"""Packet captures: DNS over UDP decoded on the executors, and flows of a second."""

from __future__ import annotations

import ipaddress
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from beaconframe.functions import columns as C
from beaconframe.session import ship

SCHEMA = "ts_us bigint, src string, dst string, sport int, dport int, size bigint, qnames array<string>, answers array<struct<code: int, ttl: bigint>>"
_ARROW = pa.schema([("ts_us", pa.int64()), ("src", pa.string()), ("dst", pa.string()), ("sport", pa.int32()), ("dport", pa.int32()), ("size", pa.int64()), ("qnames", pa.list_(pa.string())), ("answers", pa.list_(pa.struct([("code", pa.int32()), ("ttl", pa.int64())])))])
#: Record types that flows count apart.
COUNTED = ["a", "ns", "cname", "mx", "txt", "aaaa", "ptr", "other"]


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Time in microseconds and bytes of each packet of a pcap (microseconds, either byte order) or pcapng file. A file cut short ends with its last whole packet."""
    if data[:4] == b"\x0a\x0d\x0d\x0a":
        yield from _blocks(data)
        return
    order = {b"\xd4\xc3\xb2\xa1": "<", b"\xa1\xb2\xc3\xd4": ">"}.get(data[:4])
    if order is None:
        raise ValueError("no packet capture")
    at = 24
    while at + 16 <= len(data):
        seconds, micros, held, _ = struct.unpack_from(f"{order}IIII", data, at)
        if at + 16 + held > len(data):
            return
        yield seconds * 1_000_000 + micros, data[at + 16 : at + 16 + held]
        at += 16 + held


def _blocks(data: bytes) -> Iterator[tuple[int, bytes]]:
    at, order, units = 0, "<", []
    while at + 12 <= len(data):
        kind = struct.unpack_from(f"{order}I", data, at)[0]
        if data[at : at + 4] == b"\x0a\x0d\x0d\x0a":
            order, units = "<" if data[at + 8 : at + 12] == b"\x4d\x3c\x2b\x1a" else ">", []
        size = struct.unpack_from(f"{order}I", data, at + 4)[0]
        if size < 12 or at + size > len(data):
            return
        body = data[at + 8 : at + size - 4]
        if kind == 1:  # an interface: its time unit is an option
            unit, o = 1_000_000, 8
            while o + 4 <= len(body):
                code, n = struct.unpack_from(f"{order}HH", body, o)
                if code == 0:
                    break
                if code == 9 and n:
                    unit = 1 << (body[o + 4] & 127) if body[o + 4] & 128 else 10 ** body[o + 4]
                o += 4 + (n + 3) // 4 * 4
            units.append(unit)
        elif kind == 6:
            interface, high, low, held = struct.unpack_from(f"{order}IIII", body)
            yield ((high << 32) | low) * 1_000_000 // units[interface], body[20 : 20 + held]
        at += size


def _name(data: bytes, at: int) -> tuple[str, int]:
    labels, end, hops = [], -1, 0
    while True:
        n = data[at]
        if n & 0xC0 == 0xC0:
            end = at + 2 if end < 0 else end
            at = (n & 0x3F) << 8 | data[at + 1]
            if (hops := hops + 1) > 64:
                raise ValueError("names go in a circle")
        elif n:
            if at + 1 + n > len(data):
                raise IndexError("a name is cut short")
            labels.append(data[at + 1 : at + 1 + n].decode("utf-8", "replace"))
            at += 1 + n
        else:
            return ".".join(labels), at + 1 if end < 0 else end


def dns(data: bytes) -> tuple[list[str], list[dict[str, int]]]:
    """Question names (empty ones too), and type and time to live of the answers."""
    _, _, questions, answers, _, _ = struct.unpack_from(">6H", data)
    at, names, found = 12, [], []
    for _ in range(questions):
        name, at = _name(data, at)
        struct.unpack_from(">HH", data, at)
        at += 4
        names.append(name)
    for _ in range(answers):
        _, at = _name(data, at)
        code, _, ttl, n = struct.unpack_from(">HHIH", data, at)
        at += 10 + n
        if at > len(data):
            raise IndexError("an answer is cut short")
        found.append({"code": code, "ttl": ttl})
    return names, found


def dns_packet(frame: bytes) -> tuple | None:
    """Addresses, ports, names and answers of a UDP packet from or to port 53; null for all others and for what can't be decoded."""
    try:
        kind, at = struct.unpack_from(">H", frame, 12)[0], 14
        while kind in (0x8100, 0x88A8):
            kind, at = struct.unpack_from(">H", frame, at + 2)[0], at + 4
        if kind == 0x0800:
            protocol, src, dst = frame[at + 9], frame[at + 12 : at + 16], frame[at + 16 : at + 20]
            at += (frame[at] & 15) * 4
        elif kind == 0x86DD:
            protocol, src, dst = frame[at + 6], frame[at + 8 : at + 24], frame[at + 24 : at + 40]
            at += 40
        else:
            return None
        sport, dport = struct.unpack_from(">HH", frame, at)
        if protocol != 17 or 53 not in (sport, dport):
            return None
        names, answers = dns(frame[at + 8 :])
        return str(ipaddress.ip_address(src)), str(ipaddress.ip_address(dst)), sport, dport, names, answers
    except (struct.error, IndexError, ValueError):
        return None


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            rows: list[tuple] = []
            for ts, frame in frames(data.as_py()):
                if (p := dns_packet(frame)) is not None:
                    rows.append((ts, *p[:4], len(frame), *p[4:]))
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """The DNS packets of captures. One task reads one file, of 2 GB at most: longer captures are to be split at packets first."""
    ship(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_decoded, SCHEMA)


def flows(packets: DataFrame) -> DataFrame:
    """F1, G1, L1: the 19 measures of each source, destination and second, in two aggregations by that key."""
    rows = packets.withColumn("second", F.floor(F.col("ts_us") / 1_000_000).cast("bigint"))
    key = ["src", "dst", "second"]
    gap = (F.col("ts_us") - F.lag("ts_us").over(W.partitionBy(*key).orderBy("ts_us"))) / 1000
    named = F.filter("qnames", lambda q: q != "")
    ttls = F.transform("answers", lambda a: a["ttl"])
    of = lambda kind: F.size(F.filter("answers", lambda a: C.rr_type_name(a["code"]) == kind))
    total = lambda array: F.aggregate(array, F.lit(0).cast("bigint"), lambda s, x: s + x)
    names = F.array_distinct(F.flatten(F.collect_set("__q")))  # those of one second
    out = rows.withColumn("__gap", gap).withColumn("__q", named).groupBy(*key).agg(
        F.count(F.lit(1)).alias("packet_count"),
        F.sum("size").alias("byte_total"),
        F.avg("size").alias("mean_packet_size"),
        F.coalesce(F.avg("__gap"), F.lit(0.0)).alias("mean_inter_arrival_ms"),
        F.count(F.lit(1)).alias("communication_frequency"),
        F.sum(F.size("__q")).cast("bigint").alias("query_rr_count"),
        F.sum(F.size("answers")).cast("bigint").alias("answer_rr_count"),
        names.alias("__names"),
        *[F.sum(of(k)).cast("bigint").alias(f"rr_type_{k}") for k in COUNTED],
        F.coalesce(F.sum(total(ttls)) / F.nullif(F.sum(F.size("answers")), F.lit(0)), F.lit(0.0)).alias("ttl_mean"),
        F.coalesce(F.max(F.array_max(ttls)), F.lit(0)).cast("bigint").alias("ttl_max"),
    )
    n = F.size("__names")
    entropy = F.aggregate(F.transform("__names", C.shannon_entropy), F.lit(0.0), lambda a, x: a + x)
    return out.withColumn("unique_qnames", n.cast("bigint")).withColumn("dns_query_entropy_mean", F.when(n > 0, entropy / n).otherwise(0.0)).drop("__names")
