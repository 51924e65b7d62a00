"""Hierarchical multi-length packing of token streams.

Each document's tokens are cut into whole windows of the longest tier and a rest.
The rest is routed to the shortest context-size tier that holds it; every tier is
packed best-fit, longest first. Gaps of a window are then filled from shorter tiers:
whole pieces first, and a last piece cut to the gap. What stays over at the end of a
task is laid end to end and emitted at powers of two, so that it needs no padding.
Step groups, what is read together in one training step, are balanced: each has the same
number of tokens, windows of all tiers together, and windows are dealt by their attention
cost (the sum of the squares of their pieces' lengths), each to the group of least cost.

Each task packs what it reads: no shuffle, so no hot key, and memory is bounded by the
pool of rests that wait to be packed (POOL_TOKENS) and one Arrow batch. A retried task
reads the same split and makes the same sequences.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.session import ship, table

#: Context sizes, longest first; each a power of two.
TIERS = (2048, 1024, 512, 256)
#: Tokens of one step group: so many of them are read together in one training step.
STEP_TOKENS = 1 << 15
#: Tokens that wait in a task before they are packed, at most (one batch more).
POOL_TOKENS = 1 << 22
#: Step groups that windows are dealt to at a time.
GROUPS = 64
END_ID = 1

_ORDINARY_SPECIAL = "<|endoftext|>"


class IdEncoder:
    """Ids of the tokenizers library.

    If the same vocabulary stands beside the file as ranks, a faster encoder makes the
    same ids; texts with the special token's string always go to the library itself.
    """

    def __init__(self, path: str) -> None:
        import os

        from tokenizers import Tokenizer

        self.whole, self.fast = Tokenizer.from_file(path), None
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_path):
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or _ORDINARY_SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=1)
def tokenizer(path: str) -> IdEncoder:
    return IdEncoder(path)


class _Rest:
    """Tokens of one document that wait for a place."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc: object, start: int, ids: np.ndarray, total: int) -> None:
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def split(self, n: int) -> tuple[_Rest, _Rest]:
        return _Rest(self.doc, self.start, self.ids[:n], self.total), _Rest(self.doc, self.start + n, self.ids[n:], self.total)


class Packer:
    """Packs the documents of one task; sequence ids start at `first`."""

    def __init__(self, first: int, tiers: tuple[int, ...] = TIERS, pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS) -> None:
        if list(tiers) != sorted(set(tiers), reverse=True) or any(t < 1 or t & (t - 1) for t in tiers):
            raise ValueError("tiers must be distinct powers of two, longest first")
        self.tiers, self.pool_tokens, self.step_tokens = tiers, pool_tokens, step_tokens
        self.next, self.first = first, first
        self.waiting: list[_Rest] = []
        self.held = 0
        if step_tokens < tiers[0] or step_tokens & (step_tokens - 1):
            raise ValueError("step_tokens must be a power of two and hold the longest tier")
        #: Windows without a step group yet (length, cost, rows), and their tokens.
        self.open: list[tuple[int, int, list[tuple]]] = []
        self.open_tokens = self.groups = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[_Rest]) -> None:
        length, offset, rows = sum(len(p.ids) for p in pieces), 0, []
        for p in pieces:
            n = len(p.ids)
            rows.append((p.doc, p.start, n, zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, self.next, offset, length))
            offset += n
        self.next += 1
        self.open.append((length, sum(r[2] ** 2 for r in rows), rows))
        self.open_tokens += length
        if self.open_tokens >= GROUPS * self.step_tokens:
            self._deal(last=False)

    def _deal(self, last: bool) -> None:
        """Windows to as many whole step groups as they fill; the last ones of a task, of fewer tokens, are a group too.

        Longest first, dearest first: lengths are powers of two, so a group either has room for the next window or is full.
        """
        whole = self.open_tokens // self.step_tokens
        self.open.sort(key=lambda w: (-w[0], -w[1], w[2][0][5]))
        heap = [(0, self.first + self.groups + g, self.step_tokens) for g in range(whole)]
        left = []
        for length, cost, rows in self.open:
            if not heap:
                left.append((length, cost, rows))
                continue
            total, group, room = heapq.heappop(heap)
            self.rows += [(*r, group, self.step_tokens) for r in rows]
            if room > length:
                heapq.heappush(heap, (total + cost, group, room - length))
        self.groups += whole
        self.open, self.open_tokens = left, sum(w[0] for w in left)
        if last and left:
            self.rows += [(*r, self.first + self.groups, self.open_tokens) for _, _, rows in left for r in rows]
            self.groups += 1
            self.open, self.open_tokens = [], 0

    def add(self, doc: object, ids: np.ndarray) -> None:
        top = self.tiers[0]
        whole = len(ids) // top * top
        for a in range(0, whole, top):
            self._emit([_Rest(doc, a, ids[a : a + top], len(ids))])
        if whole < len(ids):
            self.waiting.append(_Rest(doc, whole, ids[whole:].copy(), len(ids)))
            self.held += len(ids) - whole
        if self.held >= self.pool_tokens:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        by_tier: dict[int, list[_Rest]] = {t: [] for t in self.tiers}
        for rest in self.waiting:
            by_tier[next(t for t in reversed(self.tiers) if t >= len(rest.ids))].append(rest)
        self.waiting, self.held = [], 0
        #: By length and an ordinal, so that ties keep their order.
        shorter = [sorted((len(r.ids), k, r) for k, r in enumerate(by_tier[t])) for t in self.tiers]
        ordinal = sum(map(len, shorter))
        over: list[_Rest] = []
        for depth, tier in enumerate(self.tiers):
            for bin_ in _best_fit(tier, [r for _, _, r in reversed(shorter[depth])]):
                gap = tier - sum(len(r.ids) for r in bin_)
                for pool in shorter[depth + 1 :]:  # whole pieces of shorter tiers, longest first
                    while gap and pool and (k := bisect_left(pool, (gap + 1, -1))):
                        n, _, rest = pool.pop(k - 1)
                        bin_.append(rest)
                        gap -= n
                while gap:  # no whole piece is short enough: one is cut
                    pool = next((p for p in reversed(shorter[depth + 1 :]) if p), None)
                    if pool is None:
                        break
                    n, _, rest = pool.pop()
                    here, left = rest.split(min(gap, n))
                    bin_.append(here)
                    gap -= len(here.ids)
                    if len(left.ids):
                        ordinal += 1
                        insort(pool, (len(left.ids), ordinal, left))
                if gap:
                    over += bin_
                else:
                    self._emit(bin_)
            shorter[depth] = []
        if not last:
            top = self.tiers[0]
            while over and sum(len(r.ids) for r in over) >= top:
                self._emit(_take(over, top))
            self.waiting, self.held = over, sum(len(r.ids) for r in over)
            return
        left = sum(len(r.ids) for r in over)
        size = self.tiers[0]
        while left:
            while size > left:
                size //= 2
            self._emit(_take(over, size))
            left -= size
        self._deal(last=True)

    def drain(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _best_fit(tier: int, rests: list[_Rest]) -> list[list[_Rest]]:
    """Bins of at most `tier` tokens; each piece, longest first, goes where it leaves the least gap."""
    gaps: list[tuple[int, int]] = []
    bins: list[list[_Rest]] = []
    for rest in rests:
        n = len(rest.ids)
        k = bisect_left(gaps, (n, -1))
        if k < len(gaps):
            gap, b = gaps.pop(k)
            bins[b].append(rest)
        else:
            gap, b = tier, len(bins)
            bins.append([rest])
        if gap > n:
            insort(gaps, (gap - n, b))
    return bins


def _take(over: list[_Rest], size: int) -> list[_Rest]:
    """The first `size` tokens of what stays over, taken out of it."""
    out, k = [], 0
    while size:
        rest = over[k]
        if len(rest.ids) > size:
            here, over[k] = rest.split(size)
            out.append(here)
            size = 0
        else:
            out.append(rest)
            size -= len(rest.ids)
            k += 1
    del over[:k]
    return out


def _schema(kind: pa.DataType, key: str) -> pa.Schema:
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group", "step_tokens"]
    return pa.schema([(key, kind), *((n, pa.int64()) for n in names)])


def _packed(batches: Iterator[pa.RecordBatch], key: str, path: str, tiers: tuple[int, ...], pool_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    context = TaskContext.get()
    packer, tok, schema = Packer((context.partitionId() if context else 0) << 40, tiers, pool_tokens), tokenizer(path), None
    end = np.array([END_ID], np.uint32)
    for batch in batches:
        schema = schema or _schema(batch.schema.field(0).type, key)
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            packer.add(doc, np.concatenate([tok.encode(text.as_py() or ""), end]))
        if len(packer.rows) > 20_000:
            yield _rows(packer.drain(), schema)
    if schema is not None:
        packer.pack(last=True)
        yield _rows(packer.drain(), schema)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack(docs: DataFrame, tokenizer_path: str | None = None, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, step_group, step_tokens.

    A document's tokens are its text's ids and then END_ID; each token lies in exactly
    one piece. sequence_tokens is the sequence's length: a tier, or a smaller power of
    two at the end of a task, so nothing is padded. step_group is unique over the table;
    its step_tokens are STEP_TOKENS, or fewer in the last group of a task. A null or empty
    text is one token. Repeated keys are packed as documents of their own; null keys
    are carried; other columns are ignored; no rows give no rows.
    """
    ship(docs.sparkSession)
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col(key), F.col(text).cast("string"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        lambda it: _packed(it, key, tokenizer_path, tiers, pool_tokens),
        f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step_group long, step_tokens long",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op7: `documents`, whole table and whole texts, as pieces of sequences."""
    return pack(table(spark, sf_dir, "documents"))
