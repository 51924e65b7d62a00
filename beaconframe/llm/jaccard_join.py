"""N-gram Jaccard self-join by chosen paths.

Documents with equal shingle sets are one *class*. A class's set is embedded by minimum
hashes; at each node of a random tree one or two positions (1 / similarity on average)
are drawn from the node's key, and a set descends to the child of its minimum hash there:
sets that share tokens tend to share paths. Nodes of one set end; those of few
sets are compared by brute force; larger ones are split again unless their mean similarity
is ALIKE or more, as splitting would hardly divide them. Trees are repeated until the
target recall: `runs_for` leaves of depth DEPTH, and for the sets that went deeper again.

Brute force is by sketches first: sets of a small leaf that seem similar are linked by a
spanning forest, those of a leaf of sets alike to its least member. Connected links make groups, and the pairs of a group are
tested exactly on the whole sets: a small group at once; a large one by its members'
differences from a central set. With r tokens of the centre missing and a added, a pair is
similar for sure if the sum of both u = r + similarity * a is small enough, so that these
links are counted from a histogram of u. The other pairs are tested on the differences, in
pairs of blocks. So a large group is shared by many tasks, no pair leaves one, and copies
of one text that differ little from each other cost about one row each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from beaconframe.session import cut, ship, table

#: Expected share of lone pairs at the threshold that are found; groups of more than two are found by any chain.
WORDS, SIMILARITY, RECALL = 5, 0.8, 0.999
SKETCH, BLOCK = 64, 256
#: Sets of a node that is compared by brute force: twice as many with each split, up to the second number.
LEAF, LARGEST = 32, 1024
#: Tokens of the sets that one task holds to compare them (8 bytes each), as long as no two sets alone are larger.
WEIGHT = 1 << 22
#: A larger node of this mean similarity, estimated from about SAMPLE of its sets, is a leaf.
ALIKE, SAMPLE = 0.6, 16
#: Depth that the first trees are counted for.
DEPTH = 4
#: Bytes of the sketch by which sets of a leaf are tested: the least token of each bin, one byte of it.
MARKS = 256
#: Sets that seem this much less similar than asked are still linked: four standard errors.
SLACK = 4 * math.sqrt(SIMILARITY * (1 - SIMILARITY) / MARKS)
#: Differences from a centre that are compared in one task, for each of two blocks.
APART = 1024
#: Sets of a large group that are tried as its centre, about.
CENTRES = 8
#: Rows for which a task is worth its files: of ids, of ids with sketches, and of whole sets (which may be long).
NARROW, WIDE, WHOLE = 1 << 15, 1 << 12, 1 << 9
_TOKEN = re.compile(r"\w+")
_RNG = np.random.default_rng(11)
_A = (_RNG.integers(1, 1 << 62, SKETCH).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RNG.integers(0, 1 << 62, SKETCH).astype(np.uint64)
CACHE_WORDS = 300_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


def shingles(text: str | None, hashes: _Hashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of `words` words (lower-cased runs of word characters); a shorter text is one run."""
    found = _TOKEN.findall(text.lower()) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    k = min(words, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ w[i : len(w) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def sketch(s: np.ndarray) -> bytes:
    """32 bits of each of the minimum hashes by which paths are chosen."""
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 512):
        h = s[a : a + 512, None] * _A[None, :] + _B[None, :]
        np.minimum(low, (h ^ (h >> np.uint64(31))).min(0), out=low)
    return ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype("<u4").tobytes()  # the first bits of a minimum are much alike


def marks(s: np.ndarray) -> bytes:
    """One byte of the least token in each of MARKS bins; 0 for an empty bin."""
    h = s * np.uint64(0xBF58476D1CE4E5B9)
    h = np.sort(h ^ (h >> np.uint64(29)))  # the first bits are the bin
    at = (h >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    out = np.zeros(MARKS, np.uint8)
    out[at[first]] = (h[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def seeming(m: np.ndarray) -> np.ndarray:
    """Estimated similarities of all pairs of rows of marks."""
    full = (m > 0).astype(np.float32)
    either = full.sum(1)[:, None] + full.sum(1)[None, :] - full @ full.T
    same = np.zeros((len(m), len(m)), np.float32)
    for k, x in enumerate(m):
        same[k] = np.count_nonzero((m == x) & (x > 0), axis=1)
    return same / np.maximum(either, 1)


def _set_key(s: np.ndarray) -> str:
    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text_key, text to id, text_key, set_key (the text_key of a text without words), n, sketch, marks."""
    hashes = _Hashes()
    for batch in batches:
        keys = batch.column(1).to_pylist()
        sets = [shingles(t, hashes) for t in batch.column(2).to_pylist()]
        set_keys = [_set_key(s) if len(s) else k for s, k in zip(sets, keys, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(set_keys, pa.string()), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()), pa.array([marks(s) for s in sets], pa.binary())],
            names=["id", "text_key", "set_key", "n", "sketch", "marks"],
        )


def _fanout(similarity: float) -> int:
    """One position, and a second one in so many of 1000 nodes: 1 / similarity on average."""
    return round(1000 * (1 / similarity - 1))


def _meets(similarity: float, depth: int, second: float) -> float:
    """Chance that a pair whose sketches agree so much is still together after so many splits."""
    p = 1.0
    for _ in range(depth):
        q = similarity * p
        p = (1 - second) * q + second * (1 - (1 - q) ** 2)
    return p


def recall_of(runs: int, depth: int, similarity: float = SIMILARITY) -> float:
    """Expected share of lone pairs at the threshold that are found: over what their sketches agree in, which all trees share, and the test by marks."""
    second, binomial = _fanout(similarity) / 1000, lambda k, n: math.comb(n, k) * similarity**k * (1 - similarity) ** (n - k)
    tested = sum(binomial(k, MARKS) for k in range(math.ceil(MARKS * (similarity - SLACK) - 1e-9), MARKS + 1))
    return tested * sum(binomial(k, SKETCH) * (1 - (1 - _meets(k / SKETCH, depth, second)) ** runs) for k in range(SKETCH + 1))


def runs_for(recall: float = RECALL, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """Trees needed for the recall if leaves lie so deep."""
    if recall_of(10_000, depth, similarity) < recall:
        raise ValueError(f"sketches of {SKETCH} give no recall of {recall}")
    runs = 1
    while recall_of(runs, depth, similarity) < recall:
        runs += 1
    return runs


def _children(node: Column, sketch_: Column, similarity: float) -> Column:
    """The one or two children of each node that a set descends to."""
    def child(salt: int) -> Column:
        at = F.pmod(F.xxhash64(node, F.lit(salt)), F.lit(SKETCH)).cast("int")
        return F.xxhash64(node, at, F.substring(sketch_, 4 * at + 1, F.lit(4)))

    two = F.pmod(F.xxhash64(node, F.lit(0)), F.lit(1000)) < _fanout(similarity)
    return F.explode(F.array_distinct(F.when(two, F.array(child(1), child(2))).otherwise(F.array(child(1)))))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _in_few(df: DataFrame, rows: int | None, each: int = NARROW) -> DataFrame:
    """df in as few tasks as about so many rows are worth, and no more than a shuffle makes; as it is if they are not known.

    Every task leaves files and events, however few rows it has: a union has the tasks of all
    its parts, and each shuffle as many as the session says. Nothing is shuffled for this.
    """
    if rows is None:
        return df
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(1, min(most, math.ceil(rows / each))))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows node, marks of a sample. Out: the nodes whose sets are alike."""
    found = []
    for node, rows in _grouped(batches):
        m = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, MARKS)
        if len(m) > 1 and (seeming(m).sum() - len(m)) / (len(m) * (len(m) - 1)) >= ALIKE:
            found.append(node)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["node"])


def _leaves(classes: DataFrame, count: int, first: int, runs: int, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """leaf, rid of the small leaves and of those of sets alike, of the trees first to runs - 1; the rids that went below DEPTH, and how many at most; the depth. count: of the classes, at most."""
    roots = F.array(*[F.xxhash64(F.lit(r), F.lit("root")) for r in range(first, runs)])
    nodes = classes.select("rid", "sketch", F.explode(roots).alias("parent")).select("rid", _children(F.col("parent"), F.col("sketch"), similarity).alias("node"))
    small, alike, deep, depth = [], [], [], 1
    rows, below = count * (runs - first), 0
    while True:
        nodes = cut(_in_few(nodes, max(rows, count * NARROW // WIDE)))  # it reads all sketches, however few go on
        sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        few = min(LEAF << (depth - 1), LARGEST)
        level = _in_few(nodes.join(sizes, "node"), rows)
        drawn = level.where((F.col("size") > few) & (F.pmod(F.xxhash64("rid", "node"), F.col("size")) < SAMPLE))
        drawn = _in_few(drawn.join(classes.select("rid", "marks"), "rid").select("node", "marks"), count, WIDE)
        ends = _in_few(drawn.repartition("node"), count, WIDE).sortWithinPartitions("node").mapInArrow(_alike, "node bigint").withColumn("alike", F.lit(True))
        level = level.join(ends, "node", "left").select(F.col("node").alias("leaf"), "rid", F.when(F.col("size") <= few, 0).when(F.col("alike"), 1).otherwise(2).alias("kind"))
        level = cut(_in_few(level, rows))
        small.append(level.where("kind = 0").drop("kind"))
        alike.append(level.where("kind = 1").drop("kind"))
        again = level.where("kind = 2")
        left = again.count()
        if not left:
            return _union(small), _union(alike), _union(deep or [again.select("rid")]), below, depth
        if depth == DEPTH:
            deep.append(again.select("rid").distinct())
            below = min(left, count)
        nodes = again.join(classes.select("rid", "sketch"), "rid").select("rid", _children(F.col("leaf"), F.col("sketch"), similarity).alias("node"))
        rows, depth = left, depth + 1


def _candidates(classes: DataFrame, count: int, similarity: float, recall: float) -> DataFrame:
    """Links a, b between classes that seem similar, enough to connect what similar pairs connect. count: of the classes, at most."""
    runs, depth, links, grown, left = 0, DEPTH, [], classes, count
    while runs < (need := runs_for(recall, similarity, depth)):
        had, rows = left, left * (need - runs)
        small, alike, deep, left, reached = _leaves(grown, had, runs, need, similarity)
        runs, depth = need, max(depth, reached)
        small, alike = _in_few(small, rows), _in_few(alike, rows)
        named = _in_few(small.join(classes.select("rid", "marks"), "rid").select("leaf", "rid", "marks"), max(rows, count), WIDE)
        links.append(_in_few(named.repartition("leaf"), rows, WIDE).sortWithinPartitions("leaf", "rid").mapInArrow(lambda it: _leaf_links(it, similarity - SLACK), "a bigint, b bigint"))
        links.append(_in_few(alike.join(alike.groupBy("leaf").agg(F.min("rid").alias("b")), "leaf").select(F.col("rid").alias("a"), "b"), rows))
        grown = _in_few(grown.join(deep, "rid", "left_semi"), had, WIDE)  # pairs that are together so deep are of these
    return _in_few(_union(links), count * runs, WIDE)


def _forest(pairs: Iterator[tuple[int, int]], n: int) -> list[int]:
    """Least member of each member's connected group."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows by their first column, which must adjoin."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[0] != now:
                yield now, rows
                rows = []
            now = row[0]
            rows.append(row)
    if rows:
        yield now, rows


def _leaf_links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for _, rows in _grouped(batches):
        rids, close = [r[1] for r in rows], seeming(np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, MARKS)) >= least
        roots = _forest(zip(*(x.tolist() for x in np.nonzero(np.triu(close, 1))), strict=True), len(rows))
        for i, r in enumerate(roots):
            if r != i:
                a.append(rids[i])
                b.append(rids[r])
        if len(a) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def contracted(links: DataFrame, rows: int | None = None) -> DataFrame:
    """The same connections by fewer links: each id to its least smaller neighbour, and that neighbour to the others.

    An id has no more smaller neighbours than leaves or blocks it lies in; the links between
    these neighbours fall together, so that about one link an id is left.
    """
    down = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = _in_few(down.groupBy("a").agg(F.collect_set("b").alias("n"), F.min("b").alias("least")), rows)
    mine = F.array(F.struct("a", F.col("least").alias("b")))
    others = F.transform(F.filter("n", lambda x: x != F.col("least")), lambda x: F.struct(x.alias("a"), F.col("least").alias("b")))
    return _in_few(near.select(F.inline(F.concat(mine, others))).distinct(), rows)


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """rid and least (the least rid connected to it) of all ids in links (a, b).

    Links are contracted first, mostly to one link to its least for each id. Else labels go to
    the least among neighbours and then to their label's label, until none changes.
    rows: about how many ids there are, if known.
    """
    fewer = cut(contracted(contracted(links, rows), rows))
    if not _in_few(fewer.join(fewer.select(F.col("b").alias("a")), "a", "left_semi"), rows).count():
        least = _in_few(fewer.select("b").distinct(), rows)
        return fewer.select(F.col("a").alias("rid"), F.col("b").alias("least")).unionByName(least.select(F.col("b").alias("rid"), F.col("b").alias("least")))
    both = _in_few(fewer.unionByName(fewer.select(F.col("b").alias("a"), F.col("a").alias("b"))), rows)
    labels = cut(_in_few(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")).withColumnRenamed("a", "rid"), rows))
    while True:
        near = _in_few(both.join(labels.withColumnRenamed("rid", "b"), "b"), rows).groupBy("a").agg(F.min("least").alias("other"))
        lower = _in_few(labels.join(near, labels.rid == near.a, "left"), rows).select("rid", F.least("least", "other").alias("least"), F.col("least").alias("was"))
        jump = lower.select(F.col("rid").alias("least"), F.col("least").alias("further"))
        moved = cut(_in_few(lower.join(jump, "least", "left").select("rid", F.least("least", "further").alias("least"), "was"), rows))
        labels = moved.select("rid", "least")
        if not moved.where("least <> was").count():
            return labels


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same columns, the last one (text) as shingles."""
    hashes = _Hashes()
    for batch in batches:
        sets = [shingles(t, hashes).tobytes() for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], names=[*batch.schema.names[:-1], "shingles"])


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs."""
    n = len(sets)
    lengths = [len(s) for s in sets]
    token, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(n), lengths)
    shared = count[at] > 1
    renumber = np.cumsum(count > 1) - 1
    token, of = renumber[at[shared]], of[shared]
    order = np.argsort(token, kind="stable")
    token, of = token[order], of[order]
    total, out = int((count > 1).sum()), np.zeros((n, n), np.float32)
    for a in range(0, total, 4096):
        lo, hi = np.searchsorted(token, [a, a + 4096])
        m = np.zeros((n, min(4096, total - a)), np.float32)
        m[of[lo:hi], token[lo:hi] - a] = 1
        out += m @ m.T
    return out


def _found(rids: list[int], copies: list[int], match: np.ndarray) -> pa.RecordBatch:
    """rid, links (copies of the sets that match) and least (of the rids that matches connect to it here)."""
    roots = _forest(zip(*(x.tolist() for x in np.nonzero(np.triu(match, 1))), strict=True), len(rids))
    return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(match @ np.array(copies, np.int64), pa.int64()), pa.array([rids[r] for r in roots], pa.int64())], names=["rid", "links", "least"])


def _whole(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows bin, rid, copies, shingles of whole small groups, in the order of bin and rid."""
    for _, rows in _grouped(batches):
        size = np.array([len(r[3]) // 8 for r in rows], np.float64)
        common = _common([np.frombuffer(r[3], np.uint64) for r in rows])
        match = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-9
        np.fill_diagonal(match, False)
        yield _found([r[1] for r in rows], [r[2] for r in rows], match)


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows least, tried (rid, marks), marks. Out: least, rid, sum of the estimated similarities of the rows to each one tried."""
    total: dict[tuple[int, int], float] = {}
    for batch in batches:
        least, tried, mine = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        known: dict[int, tuple[list[int], np.ndarray]] = {}
        for k, group in enumerate(least):
            if group not in known:
                of = tried[k].as_py()
                known[group] = [t["rid"] for t in of], np.frombuffer(b"".join(t["marks"] for t in of), np.uint8).reshape(-1, MARKS)
            rids, m = known[group]
            x = np.frombuffer(mine[k], np.uint8)
            score = ((m == x) & (x > 0)).sum(1) / np.maximum(((m > 0) | (x > 0)).sum(1), 1)
            for r, v in zip(rids, score.tolist(), strict=True):
                total[group, r] = total.get((group, r), 0.0) + round(v, 6)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int64()), pa.array([k[1] for k in total], pa.int64()), pa.array(list(total.values()), pa.float64())], names=["least", "rid", "score"])


def _differences(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    """Rows bin, mark, rid, copies, least, shingles, in the order of bin and mark; the centre's set has mark 0.

    Out: rid, copies, least, limit, u and the difference from the centre's set. In thousandths:
    u is 1000 for a missing token and `part` (the similarity) for an added one, and a pair is
    similar if and only if its u together are at most limit + (1000 + part) * common differences.
    """
    centre, limit = np.zeros(0, np.uint64), 0
    for batch in batches:
        marks, sets, us, limits, out = batch.column(1).to_pylist(), batch.column(5), [], [], []
        for k, mark in enumerate(marks):
            s = np.frombuffer(sets[k].as_buffer(), np.uint64)
            if mark == 0:
                centre = s.copy()
                limit = (1000 - part) * len(centre)
                continue
            difference = np.setxor1d(centre, s, assume_unique=True)
            missing = (len(difference) - len(s) + len(centre)) // 2
            us.append(1000 * missing + part * (len(difference) - missing))
            limits.append(limit)
            out.append(difference.tobytes())
        kept = batch.filter(pa.array([m == 1 for m in marks], pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column(2), kept.column(3), kept.column(4), pa.array(limits, pa.int64()), pa.array(us, pa.int64()), pa.array(out, pa.binary())], names=["rid", "copies", "least", "limit", "u", "difference"])


def _uncertain(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    """Rows bin, rid, copies, limit, u, block, difference: the pairs of different blocks, or of the only block, whose u exceed the limit."""
    for key, rows in _grouped(batches):
        u, block = (np.array([r[k] for r in rows], np.int64) for k in (4, 5))
        over = u[:, None] + u[None, :] - rows[0][3]
        match = (over > 0) & ((1000 + part) * _common([np.frombuffer(r[6], np.uint64) for r in rows]) >= over)
        first, second = key.split(":")[1:]
        if first == second:
            np.fill_diagonal(match, False)
        else:
            match &= block[:, None] != block[None, :]
        yield _found([r[1] for r in rows], [r[2] for r in rows], match)


def _compared(placed: DataFrame, texts: DataFrame, similarity: float, count: int | None = None) -> DataFrame:
    """rid, links (the other classes' rows that are similar), least (of what is connected to it): a row or more for each class of a group.

    placed: rid, least (the group), copies, n, text_key, marks. count: of its rows, at most.
    """
    part = round(1000 * similarity)
    if abs(part - 1000 * similarity) > 1e-6:
        raise ValueError("the similarity must be in thousandths")
    groups = _in_few(placed.groupBy("least").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight")), count)
    fits = (F.col("size") <= 2 * BLOCK) & (F.col("weight") <= WEIGHT)
    sized = _in_few(_in_few(placed.join(groups, "least"), count, WIDE).join(texts, "text_key"), count, WHOLE).select("rid", "copies", "least", "size", "weight", "marks", "text")
    kinds = "rid bigint, copies bigint, least bigint, size bigint, weight bigint, marks binary, shingles binary"
    sets = cut(sized.mapInArrow(_sets_of, kinds))
    binned = _in_few(sets.where(fits).select("least", "rid", "copies", "shingles").repartition("least"), count, WHOLE).sortWithinPartitions("least", "rid")
    found = [binned.mapInArrow(lambda it: _whole(it, similarity), "rid bigint, links bigint, least bigint")]
    large = sets.where(~fits)
    if not large.count():
        return found[0]

    # the centre: of a few members, that which seems most similar to all members
    drawn = (F.col("rid") == F.col("least")) | (F.pmod(F.xxhash64("rid", F.lit(7)), F.col("size")) < CENTRES)
    tried = large.where(drawn).groupBy("least").agg(F.array_sort(F.collect_list(F.struct("rid", "marks"))).alias("tried"))
    scored = large.join(tried, "least").select("least", "tried", "marks").mapInArrow(_scores, "least bigint, rid bigint, score double").groupBy("least", "rid").agg(F.sum("score").alias("score"))
    centres = scored.groupBy("least").agg(F.max_by("rid", F.struct("score", "rid")).alias("centre"))
    parts = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("weight") / WEIGHT)).cast("bigint")
    mine = F.pmod(F.xxhash64("rid"), parts)
    members = large.select(F.struct("least", mine.alias("part")).alias("bin"), F.lit(1).alias("mark"), "rid", "copies", "least", "shingles")
    marks = large.join(centres, "least").where("rid = centre").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    marks = marks.select(F.struct("least", "part").alias("bin"), F.lit(0).alias("mark"), "rid", "copies", "least", "shingles")
    dealt = members.unionByName(marks).repartition("bin").sortWithinPartitions("bin", "mark", "rid").withColumn("bin", F.lit(0))
    apart = cut(dealt.mapInArrow(lambda it: _differences(it, part), "rid bigint, copies bigint, least bigint, `limit` bigint, u bigint, difference binary"))

    # links that are certain: u and u of the other together within the limit; a group has no more values of u within it than the centre has tokens (by the thousand)
    counted = apart.where("u <= limit").groupBy("least", "limit", "u").agg(F.sum("copies").alias("n"), F.min("rid").alias("lowest"))
    steps = counted.select("least", F.col("u").alias("at"), F.lit(0).alias("kind"), "n", "lowest", "u").unionByName(counted.select("least", (F.col("limit") - F.col("u")).alias("at"), F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("lowest"), "u"))
    upto = W.partitionBy("least").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    certain = steps.select("least", "u", "kind", F.sum("n").over(upto).alias("certain"), F.min("lowest").over(W.partitionBy("least")).alias("lowest")).where("kind = 1").drop("kind")
    linked = apart.join(certain, ["least", "u"]).select("rid", (F.col("certain") - F.when(2 * F.col("u") <= F.col("limit"), F.col("copies")).otherwise(0)).alias("links"), F.col("lowest").alias("least"))

    # the other pairs have a member of over half the limit; blocks of these meet each other and blocks of the rest
    heavy = 2 * F.col("u") > F.col("limit")
    tokens = F.octet_length("difference") / 8
    tops = apart.groupBy("least").agg(F.max("u").alias("top"))
    known = apart.join(tops, "least").where(F.col("u") > F.col("limit") - F.col("top"))
    blocks = lambda which: F.ceil(F.greatest(F.count_if(which) / APART, F.coalesce(F.sum(F.when(which, tokens)), F.lit(0.0)) / WEIGHT)).cast("bigint")
    sizes = known.groupBy("least").agg(blocks(heavy).alias("heavies"), blocks(~heavy).alias("lights")).where("heavies > 0")
    of = F.pmod(F.xxhash64("rid", F.lit(3)), F.when(heavy, F.col("heavies")).otherwise(F.col("lights")))
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    name = lambda a, b: F.concat_ws(":", F.col("least"), a, b)
    at, light = F.col("block"), lambda k: F.concat(F.lit("l"), k.cast("string"))
    bins = F.when(heavy, F.concat(F.transform(up_to(F.col("heavies")), lambda k: name(F.least(at, k), F.greatest(at, k))), F.transform(up_to(F.col("lights")), lambda k: name(at, light(k))))).otherwise(F.transform(up_to(F.col("heavies")), lambda k: name(k, light(at))))
    number = F.when(heavy, at).otherwise(-1 - at)  # those of light blocks are negative
    spread = known.join(sizes, "least").withColumn("block", of).select(F.explode(bins).alias("bin"), "rid", "copies", "limit", "u", number.alias("block"), "difference")
    tested = spread.repartition("bin").sortWithinPartitions("bin", "rid").mapInArrow(lambda it: _uncertain(it, part), "rid bigint, links bigint, least bigint")
    return _in_few(_union([*found, linked, tested]), count, WHOLE)


def _classes(docs: DataFrame, key: str, text: str, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Of each row with words id, text_key, class_id, n_links and class (a number); of the rest id and text_key."""
    spark = docs.sparkSession
    ship(spark)
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("id"), F.md5(whole).alias("text_key"), whole.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    sets = cut(rows.mapInArrow(_sketched, f"id {kind}, text_key string, set_key string, n bigint, sketch binary, marks binary"))
    worded = sets.where("n > 0")
    classes = worded.groupBy("set_key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min("text_key").alias("text_key"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value("marks").alias("marks"))
    count = sets.count()
    classes = cut(_in_few(classes, count, WIDE).withColumn("rid", F.monotonically_increasing_id()))
    count = classes.count()
    groups = components(_candidates(classes, count, similarity, recall), count)
    placed = _in_few(groups.join(classes.select("rid", "copies", "n", "text_key", "marks"), "rid"), count, WIDE)
    texts = rows.select("text_key", "text").groupBy("text_key").agg(F.any_value("text").alias("text"))  # one of equal texts
    found = cut(_compared(placed, texts, similarity, count))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rid").alias("a"), F.col("least").alias("b")), count)
    labelled = _in_few(classes.select("rid", "set_key", "first", "copies").join(joined, "rid", "left").join(links, "rid", "left"), count, WIDE)
    labelled = labelled.select("set_key", "first", F.coalesce("least", "rid").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    names = labelled.groupBy("class").agg(F.min("first").alias("class_id"))
    per_set = labelled.join(names, "class").select("set_key", "class", "class_id", "n_links")
    return worded.select("id", "text_key", "set_key").join(per_set, "set_key").select("id", "text_key", "class_id", "n_links", "class"), sets.where("n = 0").select("id", "text_key")


def similarity_join(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document: key, class_id, n_links.

    class_id is the least key among all documents that links of `similarity` or more connect
    to it; n_links is the number of other documents that are similar to it, equal ones too.
    Null, empty and wordless texts link to nothing and are classes of their own. Repeated
    rows are documents of their own; rows with a null key take part, and a class of null
    keys alone has a null class_id. Other columns are ignored; no rows give no rows.
    """
    worded, wordless = _classes(docs, key, text, similarity, recall)
    alone = wordless.select("id", F.col("id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    return worded.select("id", "class_id", "n_links").unionByName(alone).select(F.col("id").alias(key), F.col("class_id").alias("class_id"), "n_links")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs, with all its columns, of each group of near copies.

    The row of the least key stays (a null key comes last, then the least MD5 of the text
    decides); of rows with that key and text any one. Texts without words are in a group if
    they are equal, all null ones too. No rows give no rows; columns may have any names.
    """
    worded, wordless = _classes(docs, key, text, SIMILARITY, RECALL)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "text_key")
    counted = lambda rows, *by: rows.groupBy(*by, "id", "text_key").agg(F.count(F.lit(1)).alias("rows")).groupBy(*by).agg(F.min_by(F.struct("id", "text_key", "rows"), order).alias("stays"))
    # names that docs can't have: its own and those with one mark more
    free = "_" * (1 + max(map(len, docs.columns)))
    stays = counted(worded, "class").select("stays.*").unionByName(counted(wordless.withColumn("class", F.col("text_key")), "class").select("stays.*")).toDF(f"{free}i", f"{free}k", f"{free}n")
    marked = docs.withColumn(f"{free}t", F.md5(F.col(f"`{text}`").cast("string")))
    same = F.col(f"`{key}`").eqNullSafe(F.col(f"{free}i")) & F.col(f"{free}t").eqNullSafe(F.col(f"{free}k"))
    kept = marked.join(stays, same).drop(f"{free}i", f"{free}k")
    single = kept.where(F.col(f"{free}n") == 1)
    several = kept.where(F.col(f"{free}n") > 1)
    if not stays.where(F.col(f"{free}n") > 1).isEmpty():
        numbered = several.dropDuplicates([key, f"{free}t"])
        single = single.unionByName(numbered)
    return single.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op4: classes and links of `documents`, whole table and whole texts."""
    return similarity_join(table(spark, sf_dir, "documents"))
