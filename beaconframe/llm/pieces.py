"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The agenda takes the best-scored adjacent pair whose union is a piece (leftmost on ties)
until none is left. With dropout, a candidate merge is skipped if a keyed hash of its
place says so: the key is the seed, the document, the word's place in it, and the
candidate's start, middle and end. So a run can be repeated anywhere, and other seeds,
documents and places are drawn independently. Merges never cross the start of a word.

Work is shared where the outcome is the same: only a merge that the agenda comes to has to
be drawn, so the distinct words of a batch are merged without skips first, and each
occurrence draws along that path up to its first skip. Occurrences of one word with the
same first skip go on together from there, and so on until nothing is skipped. Words of
over SHARED characters are merged one by one, those of over LONG by an agenda of their own.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.session import ship, table

SPACE = "▁"
DROPOUT, SEED, SHARED, LONG = 0.1, 17, 14, 40
#: Bytes of text that are encoded together, about: what a task holds is some hundred times as much.
JOINED = 6 << 20
#: Words of one length that are merged together: few enough for the processor's caches.
ROUND = 1 << 13
_WORD = re.compile(r" *[^ ]+| +")
_NONE = np.int64(1) << 40
_LOW, _ALL = (1 << 21) - 1, (1 << 64) - 1
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Pieces:
    """A SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        spelled = [byte_of.get(i) or p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.byte_size = np.array([len(s) for s in spelled], np.int64)
        self.byte_start = np.cumsum(self.byte_size) - self.byte_size
        self.byte_flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.chars = {p: i for p, i in self.ids.items() if len(p) == 1}
        self.of_char = -2 - np.arange(0x110000, dtype=np.int64)
        for c, i in self.chars.items():
            self.of_char[ord(" " if c == SPACE else c)] = i
        order = sorted(self.ids.values(), key=lambda i: -model.get_score(i))
        rank = np.zeros(n, np.int64)
        rank[order] = np.arange(len(order))
        self.n, self.rank, self.ranked = n, rank, np.array(order, np.int64)
        pairs = sorted((self.ids[p[:k]] * n + self.ids[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids)
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.union = np.array([i for _, i in pairs] or [0], np.int64)
        self.pair = dict(pairs)

    def symbols(self, words: list[str]) -> np.ndarray:
        """A piece for each character of all words; -2 - code point for those without one, and for a literal word mark."""
        return self.of_char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = np.where((left >= 0) & (right >= 0), left * self.n + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((key >= 0) & (self.keys[at] == key), self.union[at], -1)

    def agenda(self, symbols: list[int], key: int, dropout: float) -> list[int]:
        """One word by a heap of candidates: the plain form of the method."""
        n = len(symbols)
        sym, start, after, before = list(symbols), list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []
        end = lambda i: start[after[i]] if after[i] < n else n

        def propose(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and sym[i] >= 0 and sym[j] >= 0 and (u := self.pair.get(sym[i] * self.n + sym[j])) is not None:
                if not _skips(key, start[i] << 42 ^ start[j] << 21 ^ end(j), dropout):
                    heapq.heappush(heap, (int(self.rank[u]), i, sym[i], sym[j]))

        for i in range(n - 1):
            propose(i)
        gone = [False] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], gone[j], after[i] = self.pair[a * self.n + b], True, after[j]
            if after[j] < n:
                before[after[j]] = i
            propose(before[i])
            propose(i)
        return [s for s, g in zip(sym, gone, strict=True) if not g]

    def _rounds(self, sym: np.ndarray, start: np.ndarray, skip: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of equally many pieces (-1 fills up at the right), a step of each agenda a round.

        Gives the pieces left, and the place and union of each merge done, in order (-1: no more).
        """
        n, width = sym.shape
        final, places, unions = np.full((n, width), -1, np.int64), np.full((n, max(0, width - 1)), -1, np.int64), np.zeros((n, max(0, width - 1)), np.int64)
        rows = np.arange(n)

        def ranks(r: np.ndarray, i: np.ndarray) -> np.ndarray:
            u = self._lookup(sym[r, i], sym[r, i + 1])
            out = np.where(u >= 0, self.rank[u], _NONE)
            hit = np.flatnonzero(u >= 0)
            r, i = r[hit], i[hit]
            out[hit[skip(rows[r], _place(start[r, i], start[r, i + 1], start[r, i + 2]))]] = _NONE
            return out

        rank = ranks(*np.divmod(np.arange(n * (width - 1)), max(1, width - 1))).reshape(n, width - 1)
        step = 0
        while width > 1:
            best = rank.argmin(1)
            least = rank[np.arange(len(rank)), best]
            live = least < _NONE
            if not live.all():
                final[rows[~live], :width] = sym[~live]
                rows, sym, start, rank, best, least = (x[live] for x in (rows, sym, start, rank, best, least))
                if not len(rows):
                    return final, places, unions
            here = np.arange(len(rows))
            places[rows, step] = _place(start[here, best], start[here, best + 1], start[here, best + 2])
            sym[here, best] = unions[rows, step] = self.ranked[least]
            gone = np.arange(width + 1) == (best + 1)[:, None]
            sym, start, rank = sym[~gone[:, :-1]].reshape(len(rows), width - 1), start[~gone].reshape(len(rows), width), rank[~gone[:, 1:-1]].reshape(len(rows), width - 2)
            width, step = width - 1, step + 1
            for at in (best - 1, best):
                ok = np.flatnonzero((at >= 0) & (at < width - 1))
                rank[ok, at[ok]] = ranks(ok, at[ok])
        final[rows, :width] = sym
        return final, places, unions

    def _each(self, sym: np.ndarray, keys: np.ndarray, dropout: float) -> np.ndarray:
        """Words of one length, each under its own key."""
        n, width = sym.shape
        out = np.full((n, width), -1, np.int64)
        for a in range(0, n, ROUND):
            mine = keys[a : a + ROUND]
            out[a : a + ROUND] = self._rounds(sym[a : a + ROUND].copy(), np.tile(np.arange(width + 1), (len(mine), 1)), lambda r, p: skipped(mine[r], p, dropout))[0]  # noqa: B023
        return out

    def _resumed(self, sym: np.ndarray, done: np.ndarray, places: np.ndarray, unions: np.ndarray, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of one length after their first `done` merges of the given ones, merged on without the barred places."""
        n, width = sym.shape
        before = np.arange(width - 1) < done[:, None]
        final, places, unions = np.full((n, width), -1, np.int64), np.where(before, places, -1), np.where(before, unions, 0)
        order = np.argsort(-done, kind="stable")
        for a in range(0, n, ROUND):
            rows = order[a : a + ROUND]
            s, lives, given = sym[rows], np.ones((len(rows), width + 1), bool), places[rows]
            for k in range(int(done[rows].max())):
                r = np.flatnonzero(given[:, k] >= 0)
                s[r, given[r, k] >> 42] = unions[rows[r], k]
                lives[r, given[r, k] >> 21 & _LOW] = False
            w = width - int(done[rows].min())
            r, c = np.nonzero(lives)
            to = (np.cumsum(lives, 1) - 1)[r, c]
            start, now = np.full((len(rows), w + 1), width, np.int64), np.full((len(rows), w), -1, np.int64)
            start[r, to] = c
            inner = c < width
            now[r[inner], to[inner]] = s[r[inner], c[inner]]
            never = barred[rows]
            f, p, u = self._rounds(now, start, lambda r, p: (never[r] == p[:, None]).any(1))  # noqa: B023
            final[rows, :w] = f
            r, k = np.nonzero(p >= 0)
            places[rows[r], done[rows[r]] + k] = p[r, k]
            unions[rows[r], done[rows[r]] + k] = u[r, k]
        return final, places, unions

    def _together(self, words: np.ndarray, word: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (word, key) of the distinct words of one length. Out: outcomes, and each occurrence's outcome."""
        n, width = words.shape
        owner, barred = np.arange(n), np.zeros((n, 0), np.int64)
        final, places, unions = self._resumed(words, np.zeros(n, np.int64), np.full((n, width - 1), -1, np.int64), np.zeros((n, width - 1), np.int64), barred)
        finals, made, outcome = [final], 0, word.copy()
        live, state, done = np.arange(len(word) if dropout else 0), word, np.zeros(len(word), np.int64)
        while len(live):
            hit, todo = np.full(len(live), -1), np.arange(len(live))
            for k in range(int(done.min()), width - 1):
                ready = todo[done[todo] <= k]
                place = places[state[ready], k]
                ready, place = ready[place >= 0], place[place >= 0]
                hit[ready[skipped(keys[live[ready]], place, dropout)]] = k
                todo = todo[hit[todo] < 0]
            outcome[live] = made + state
            at = np.flatnonzero(hit >= 0)
            cases, back = np.unique(state[at] * width + hit[at], return_inverse=True)
            if not len(cases):
                break
            made += len(final)
            parent, stop = np.divmod(cases, width)
            owner, barred = owner[parent], np.c_[barred[parent], places[parent, stop]]
            final, places, unions = self._resumed(words[owner], stop, places[parent], unions[parent], barred)
            finals.append(final)
            live, state, done = live[at], back, stop[back]
        return np.concatenate(finals), outcome

    def encode_all(self, texts: list[str | None], docs: list[int], seed: int = SEED, dropout: float = DROPOUT) -> list[np.ndarray]:
        """The ids of each text; docs has a 64-bit key for each."""
        found = [_WORD.findall(" " + t) if t else [] for t in texts]
        sizes = np.array([len(f) for f in found], np.int64)
        if not sizes.sum():
            return [np.zeros(0, np.int32) for _ in texts]
        coded = pa.array([w for f in found for w in f]).dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        doc = np.repeat(np.array(docs, np.int64).view(np.uint64), sizes)
        keys = _mix(_mix(doc + np.uint64(seed & _ALL)) + place.astype(np.uint64) * _M1)
        symbols, width = self.symbols(distinct), np.fromiter(map(len, distinct), np.int64, len(distinct))
        first, rank = np.cumsum(width) - width, np.zeros(len(distinct), np.int64)
        back, lengths, flat, made = np.zeros(len(which), np.int64), [], [], 0
        by_word, by_place = np.argsort(width, kind="stable"), np.argsort(width[which].astype(np.int16) if width.max() < 1 << 15 else width[which], kind="stable")
        word_ends, place_ends = np.cumsum(np.bincount(width)), np.cumsum(np.bincount(width[which]))
        for n in np.unique(width).tolist():
            mine, here = by_word[word_ends[n - 1] : word_ends[n]], by_place[place_ends[n - 1] : place_ends[n]]
            rank[mine] = np.arange(len(mine))
            words, word = symbols[first[mine][:, None] + np.arange(n)], rank[which[here]]
            if n <= SHARED or not dropout and n <= LONG:
                out, outcome = self._together(words, word, keys[here], dropout)
            elif n <= LONG:
                out, outcome = self._each(words[word], keys[here], dropout), np.arange(len(here))
            else:
                each, outcome = np.unique(word, return_inverse=True) if not dropout else (word, np.arange(len(here)))
                ids = [self.agenda(words[w].tolist(), k, dropout) for w, k in zip(each.tolist(), keys[here].tolist())]  # noqa: B905
                out = np.full((len(ids), n), -1, np.int64)
                for k, i in enumerate(ids):
                    out[k, : len(i)] = i
            size, ids = (out != -1).sum(1), out[out != -1]
            if ids.min() < -1:
                size, ids = self._with_bytes(size, ids)
            back[here] = made + outcome
            made += len(out)
            lengths.append(size)
            flat.append(ids.astype(np.int32))
        length, ids = np.concatenate(lengths), np.concatenate(flat)
        starts, size = np.cumsum(length) - length, length[back]
        to = np.cumsum(size)
        ids = ids[np.repeat(starts[back] - (to - size), size) + np.arange(to[-1])]
        ends = np.r_[0, to][np.r_[0, np.cumsum(sizes)]]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _with_bytes(self, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and pieces with byte pieces for characters without a piece."""
        spelled = {s: [self.bytes[b] for b in chr(-2 - s).encode("utf-8", "surrogatepass")] for s in np.unique(ids[ids < 0]).tolist()}
        count = np.ones(len(ids), np.int64)
        for s, b in spelled.items():
            count[ids == s] = len(b)
        to, of = np.cumsum(count), np.repeat(np.arange(len(size)), size)
        out = np.repeat(ids, count)
        for s, b in spelled.items():
            at = to[ids == s] - len(b)
            for k, i in enumerate(b):
                out[at + k] = i
        return np.bincount(of, count, len(size)).astype(np.int64), out

    def decode_all(self, encoded: list[np.ndarray]) -> list[bytes]:
        """Of each text's ids, whatever its segmentation, the text in UTF-8."""
        sizes = np.array([len(i) for i in encoded], np.int64)
        if not sizes.sum():
            return [b"" for _ in encoded]
        ids = np.concatenate(encoded)
        size = self.byte_size[ids]
        to = np.cumsum(size)
        out = self.byte_flat[np.repeat(self.byte_start[ids] - (to - size), size) + np.arange(to[-1])].tobytes()
        ends = np.r_[0, to][np.r_[0, np.cumsum(sizes)]].tolist()
        return [out[a + 1 : b] for a, b in zip(ends[:-1], ends[1:], strict=True)]  # without the mark before the first word

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0].decode("utf-8", "surrogatepass")


def _place(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (start << 42) ^ (middle << 21) ^ end


def skipped(key: np.ndarray, place: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the keyed hash skips each candidate merge."""
    if not dropout:
        return np.zeros(len(key), bool)
    place = place.astype(np.uint64)
    return (_mix(_mix(key + place * _M1) ^ place) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


def _skips(key: int, place: int, dropout: float) -> bool:
    """skipped() of one candidate."""
    x = (key + place * int(_M1)) & _ALL
    for last in (place, 0):
        x = ((x ^ x >> 30) * int(_M2)) & _ALL
        x = ((x ^ x >> 27) * int(_M3)) & _ALL
        x ^= x >> 31 ^ last
    return (x >> 11) * 2.0**-53 < dropout


@lru_cache(maxsize=1)
def model(path: str) -> Pieces:
    return Pieces(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, seed: int, dropout: float) -> Iterator[pa.RecordBatch]:
    pieces = model(path)
    for batch in batches:
        texts, docs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        ids = pieces.encode_all(texts, docs, seed, dropout)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if t is None else i for t, i in zip(texts, ids, strict=True)], pa.list_(pa.int32()))], names=[batch.schema.names[0], "ids"])


def _path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """key and ids (array of int): each text's pieces under merge-dropout; null for a null text, empty for an empty one.

    Rows of equal key and text get equal ids. Other columns are ignored.
    """
    ship(docs.sparkSession)
    p = _path(path)
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"), F.xxhash64(F.col(key)).alias("__doc"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lambda it: _encoded(it, p, seed, dropout), f"`{key}` {kind}, ids array<int>")


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = model(path)
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        given = [i.values.to_numpy(zero_copy_only=False) if i.is_valid else None for i in batch.column(at)]
        back = iter(pieces.decode_all([i for i in given if i is not None]))
        texts = [None if i is None else next(back).decode("utf-8", "surrogatepass") for i in given]
        columns = [c for k, c in enumerate(batch.columns) if k != at]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[n for n in batch.schema.names if n != "ids"] + ["text"])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The text of column ids, in its place `text`; null for null."""
    ship(encoded.sparkSession)
    p = _path(path)
    kept = [f for f in encoded.schema if f.name not in ("ids", "text")]
    declared = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return encoded.select(*[F.col(f"`{f.name}`") for f in kept], "ids").mapInArrow(lambda it: _decoded(it, p), f"{declared}text string")


def _joined(batches: Iterator[pa.RecordBatch], least: int = JOINED) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `least` bytes: the more words together, the fewer distinct ones to merge."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _digests(batches: Iterator[pa.RecordBatch], path: str, seed: int, dropout: float) -> Iterator[pa.RecordBatch]:
    """Encodes, and decodes again, without keeping the ids."""
    pieces = model(path)
    for batch in _joined(batches):
        texts, docs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        ids = pieces.encode_all(texts, docs, seed, dropout)
        back = pieces.decode_all(ids)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b in back]),
                pa.array([b == (t or "").encode("utf-8", "surrogatepass") for b, t in zip(back, texts, strict=True)]),
            ],
            names=[batch.schema.names[0], "n_pieces", "ids_crc32", "decoded_sha256", "lossless"],
        )


def query(spark, sf_dir: str) -> DataFrame:
    """Per document the number and CRC-32 of its ids, the SHA-256 of the text decoded from them, and whether that is the text."""
    ship(spark)
    p = _path(None)
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.xxhash64("doc_id").alias("__doc"))
    return rows.mapInArrow(lambda it: _digests(it, p, SEED, DROPOUT), "doc_id bigint, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, lossless boolean")
