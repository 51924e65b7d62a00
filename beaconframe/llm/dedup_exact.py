"""Exact dedup by two-pass Bloom filtering.

Pass 1 turns each text into a SHA-256 and builds a two-level Bloom filter: a slot
is *seen* after one document and *repeated* after a second one that hits the same
slots. Pass 2 checks each digest against the *repeated* level: only documents that
may have an equal are shuffled; all others pass straight through. A false positive
only shuffles a row in vain, so the result is exact at every filter size. What is shuffled
are ids and digests, never texts. The filter's size follows the input up to a bound
(`max_slots`), as it has to fit each worker; `false_share` says what that costs beyond it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.session import cut, ship

#: Slots per level of the filter: 16 per row, within these bounds. The broadcast
#: level is MAX_SLOTS / 8 = 64 MiB at most, whatever the input's size.
SLOTS_PER_ROW, MIN_SLOTS, MAX_SLOTS = 16, 1 << 16, 1 << 29
#: Hashes of a task that are turned into filter blocks at once.
HASHES = 1 << 20
#: Slots per hash; they lie in one block, so that blocks can be merged apart.
PROBES, BLOCK_SLOTS = 4, 1 << 16


def _slots(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number, and the PROBES slots within it, of 64-bit hashes."""
    h = hashes.view(np.uint64)
    block = ((h >> np.uint64(40)) % np.uint64(blocks)).astype(np.int64)
    a = (h & np.uint64(0xFFFF)).astype(np.int64)
    b = ((h >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64) | 1
    return block, (a[:, None] + np.arange(PROBES) * b[:, None]) % BLOCK_SLOTS


def _digest_batches(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(1)
        raw = [hashlib.sha256(t.as_buffer().to_pybytes().lower() if t.is_valid else b"").digest() for t in text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.hex() for r in raw]), pa.array([int.from_bytes(r[:8], "little", signed=True) for r in raw], pa.int64())],
            names=[key, "text_sha256", "hash"],
        )


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text_sha256 of the text with A-Z alone lower-cased (null: empty), and 64 bits of it."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key), F.col(text).cast("string"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lambda it: _digest_batches(it, key), f"`{key}` {kind}, text_sha256 string, hash bigint")


def false_share(rows: int, max_slots: int = MAX_SLOTS) -> float:
    """Share of the distinct texts among `rows` that the filter takes for repeated ones, and so are shuffled in vain."""
    x = PROBES * rows / max(MIN_SLOTS, min(max_slots, rows * SLOTS_PER_ROW))
    return float((1 - np.exp(-x)) ** PROBES)  # each of its slots is hit by another document


def _partial(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """The filter blocks that this task's hashes touch, each level as sorted slot numbers or as bits, whichever is smaller."""
    seen: list[np.ndarray] = []
    for batch in batches:
        seen.append(batch.column(0).to_numpy(zero_copy_only=False))
        if sum(map(len, seen)) >= HASHES:
            yield from _touched(np.concatenate(seen), blocks)
            seen = []
    if seen:
        yield from _touched(np.concatenate(seen), blocks)


def _touched(hashes: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    if not len(hashes):
        return
    block, slots = _slots(hashes, blocks)
    order = np.argsort(block, kind="stable")
    block, slots, hashes = block[order], slots[order], hashes[order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    out: list[tuple[int, bytes]] = []
    for a, b in zip(starts, np.r_[starts[1:], len(block)], strict=True):
        out.append((int(block[a]), _pack(slots[a:b])))
        if len(out) >= 256:
            yield _blocks(out)
            out = []
    if out:
        yield _blocks(out)


def _pack(slots: np.ndarray) -> bytes:
    """How many documents hit each slot, cut at 2; a document counts once for a slot."""
    flat = np.sort(slots, axis=1)
    first = np.c_[np.ones(len(flat), bool), flat[:, 1:] != flat[:, :-1]]
    value, count = np.unique(flat[first], return_counts=True)
    if len(value) * 4 < BLOCK_SLOTS // 4:
        return b"s" + (value.astype("<u4") | np.where(count > 1, 1 << 31, 0).astype("<u4")).tobytes()
    full = np.zeros(BLOCK_SLOTS, np.uint8)
    full[value] = np.minimum(count, 2)
    return b"d" + np.packbits(full > 0).tobytes() + np.packbits(full > 1).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    full = np.zeros(BLOCK_SLOTS, np.uint8)
    if data[:1] == b"s":
        value = np.frombuffer(data, "<u4", offset=1)
        full[value & np.uint32(0x7FFFFFFF)] = 1 + (value >> np.uint32(31))
    else:
        half = BLOCK_SLOTS // 8
        full += np.unpackbits(np.frombuffer(data, np.uint8, half, 1)) + np.unpackbits(np.frombuffer(data, np.uint8, half, 1 + half))
    return full


def _blocks(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "data"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one block adjoin; their counts are added up to 2. Out comes the repeated level."""
    now, total = None, np.zeros(0, np.uint8)
    out: list[tuple[int, bytes]] = []
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if block != now:
                if now is not None:
                    out.append((now, np.packbits(total > 1).tobytes()))
                now, total = block, np.zeros(BLOCK_SLOTS, np.uint8)
            total = np.minimum(total + _unpack(data.as_py()), 2)
        if len(out) >= 64:
            yield _blocks(out)
            out = []
    if now is not None:
        out.append((now, np.packbits(total > 1).tobytes()))
    if out:
        yield _blocks(out)


def repeated_filter(hashes: DataFrame, rows: int, max_slots: int = MAX_SLOTS) -> tuple[int, dict[int, bytes]]:
    """The repeated level of the Bloom filter over column hash: number of blocks, and each block's bits.

    It has at most max_slots bits, so it fits the driver and a broadcast whatever the
    input's size.
    """
    blocks = max(MIN_SLOTS, min(max_slots, rows * SLOTS_PER_ROW)) // BLOCK_SLOTS
    partial = hashes.select("hash").mapInArrow(lambda it: _partial(it, blocks), "block bigint, data binary")
    merged = partial.repartition("block").sortWithinPartitions("block").mapInArrow(_merged, "block bigint, data binary")
    return blocks, {r.block: bytes(r.data) for r in merged.toLocalIterator()}


def _marked(batches: Iterator[pa.RecordBatch], blocks: int, level) -> Iterator[pa.RecordBatch]:
    bits = level.value
    for batch in batches:
        block, slots = _slots(batch.column("hash").to_numpy(zero_copy_only=False), blocks)
        maybe = np.zeros(batch.num_rows, bool)
        for b in np.unique(block):
            if data := bits.get(int(b)):
                mine = np.flatnonzero(block == b)
                full = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
                maybe[mine] = full[slots[mine]].all(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=[*batch.schema.names, "maybe_repeated"])


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", max_slots: int = MAX_SLOTS) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Columns: key, keep_id, group_size (long), kept (boolean), text_sha256. Texts are
    equal if identical after lower-casing A-Z only; a null text counts as empty. The
    row with the largest key stays. Rows that share that largest key are all kept
    (they can't be told apart); rows with a null key stay only in a group of nulls
    alone. Other columns of docs are ignored, so clashing names do no harm; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    hashed = cut(digests(docs, key, text))
    blocks, bits = repeated_filter(hashed, hashed.count(), max_slots)
    level = spark.sparkContext.broadcast(bits)
    kind = hashed.schema[key].dataType.simpleString()
    marked = hashed.mapInArrow(lambda it: _marked(it, blocks, level), f"`{key}` {kind}, text_sha256 string, hash bigint, maybe_repeated boolean")
    id_ = F.col(key)
    once = marked.where(~F.col("maybe_repeated")).select(id_, id_.alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = marked.where("maybe_repeated").select(id_, "text_sha256")
    groups = maybe.groupBy("text_sha256").agg(F.max(id_).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = cut(groups)  # with a shuffle of its own below the join, a hot digest can be split there
    several = maybe.join(groups, "text_sha256").select(id_, "keep_id", "group_size", id_.eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return once.unionByName(several)


SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""
