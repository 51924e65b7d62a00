"""SimHash fingerprints and a search by permuted block tables, in DataFrame functions alone.

Terms are shingles of five words (a shorter text is one term); a term votes as often as
it occurs. Votes are counted in two 32-bit fields of a long, so 32 sums per text hold
the 64 bits, and partial sums leave each task as one row per text. For the search a
fingerprint is cut into BLOCKS blocks; each choice of BLOCKS - radius of them is a
table. Two fingerprints within the radius differ in at most `radius` blocks, so they
agree on all blocks of at least one table.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconframe.session import cut, table

WORDS, BITS, BLOCKS, RADIUS = 5, 64, 6, 3
#: First bit and width of each block.
_CUTS = [(i * BITS // BLOCKS, (i + 1) * BITS // BLOCKS - i * BITS // BLOCKS) for i in range(BLOCKS)]


def terms(text: Column, words: int = WORDS) -> Column:
    """64-bit hashes of the text's shingles: words are runs of letters and digits, lower-cased."""
    found = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    shingles = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))
    each = lambda w: F.when(F.size(w) >= words, shingles(w)).when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.array().cast("array<bigint>"))
    return F.element_at(F.transform(F.array(found), each), 1)  # the lambda binds the words: they are split once


def _votes(h: Column) -> list[Column]:
    one, half = F.lit(1).cast("bigint"), BITS // 2
    return [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(one) + F.shiftleft(F.shiftrightunsigned(h, k + half).bitwiseAND(one), 32)).alias(f"__v{k}") for k in range(half)]


def _signs() -> Column:
    """Bit k is set if more than half of the votes are for it; ties and texts without words give 0."""
    low, half = F.lit(0xFFFFFFFF).cast("bigint"), BITS // 2
    bit = lambda count, k: F.when(count * 2 > F.col("__n"), F.shiftleft(F.lit(1).cast("bigint"), k)).otherwise(F.lit(0).cast("bigint"))
    bits = [bit(F.col(f"__v{k}").bitwiseAND(low), k) for k in range(half)] + [bit(F.shiftrightunsigned(F.col(f"__v{k}"), 32), k + half) for k in range(half)]
    return F.coalesce(reduce(lambda a, b: a.bitwiseOR(b), bits), F.lit(0).cast("bigint"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and fp (bigint): the SimHash of each text. Rows of equal keys must have equal texts; they give one row.

    A null or empty text has fingerprint 0.
    """
    voted = texts.select(*keys, F.explode_outer(terms(F.col(text))).alias("__h"))
    counted = voted.groupBy(*keys).agg(*_votes(F.col("__h")), F.count("__h").alias("__n"))
    return counted.select(*keys, _signs().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def text_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def _block(fp: Column, b: int) -> Column:
    at, width = _CUTS[b]
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _tables(fp: str, radius: int) -> Column:
    """A struct of table number and key for each table."""
    out = []
    for t, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        key = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(_block(F.col(fp), b), sum(_CUTS[c][1] for c in chosen[:i])) for i, b in enumerate(chosen)])
        out.append(F.struct(F.lit(t).alias("t"), key.alias("k")))
    return F.explode(F.array(*out))


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """q, fp, distance of all pairs within the radius; queries has distinct column q, fps distinct column fp (bigint).

    A pair is made in one table alone: that of the first blocks on which it agrees. The
    fingerprints that share a block's value are compared within a join on that value,
    which adaptive execution splits where it is hot.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"{BLOCKS} blocks serve a radius below {BLOCKS}")
    tables = list(combinations(range(BLOCKS), BLOCKS - radius))
    a = queries.select("q", _tables("q", radius).alias("x")).select("q", "x.t", "x.k").alias("a")
    b = fps.select("fp", _tables("fp", radius).alias("x")).select("fp", "x.t", "x.k").alias("b")
    differs = F.col("a.q").bitwiseXOR(F.col("b.fp"))
    same = [_block(differs, i) == 0 for i in range(BLOCKS)]
    rank = [sum((F.when(same[j], 1).otherwise(0) for j in range(i)), F.lit(0)) for i in range(BLOCKS)]
    first = [F.when(same[i] & (rank[i] < BLOCKS - radius), F.lit(1 << i)).otherwise(0) for i in range(BLOCKS)]
    mask = F.element_at(F.array(*[F.lit(sum(1 << i for i in chosen)) for chosen in tables]), F.col("a.t") + 1)
    close = F.bit_count(differs) <= radius
    pairs = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.k") == F.col("b.k")) & close & (sum(first[1:], first[0]) == mask))
    return pairs.select("q", "fp", F.bit_count(differs).alias("distance"))


def _ordered(base: DataFrame) -> DataFrame:
    """doc_id, h, n, copies and, as next_id and next_h, what follows in ascending (doc_id, h); the first after the last.

    Rows are numbered within range partitions; only the partitions' sizes go to the driver.
    """
    narrow = base.groupBy("doc_id", "h", "n").agg(F.count(F.lit(1)).alias("copies"))
    numbered = cut(narrow.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").withColumn("mid", F.monotonically_increasing_id()))
    part = F.shiftright("mid", 33)
    sizes = sorted((r.p, r.n) for r in numbered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    after = base.sparkSession.createDataFrame([(p << 33) + n - 1, sizes[(i + 1) % len(sizes)][0] << 33] for i, (p, n) in enumerate(sizes)) if sizes else None
    if after is None:
        return numbered.select("doc_id", "h", "n", "copies", F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"))
    ends = F.broadcast(after.toDF("mid", "then"))  # a row for each partition
    stepped = numbered.join(ends, "mid", "left").select("doc_id", "h", "n", "copies", F.coalesce("then", F.col("mid") + 1).alias("mid"))
    following = numbered.select("mid", F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"))
    return stepped.join(following, "mid").drop("mid")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """A row per document: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_within.

    The edited text ends in the first floor(n/4) code points of the next document, in
    ascending key (ties by the text's hash; rows equal in both are one document, given
    as often as they occur). A null text is empty, a null key comes first. near_* is the
    share of equal bits. n_within, for keys divisible by 20, is the number of other
    documents within the Hamming radius (null for the rest). Other columns are ignored;
    an empty table gives no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(F.col(key).alias("doc_id"), body.alias("body")).select("doc_id", F.xxhash64("body").alias("h"), F.length("body").cast("bigint").alias("n"), "body")
    order = cut(_ordered(base))
    mine = lambda l, r: F.col(f"{l}.doc_id").eqNullSafe(F.col(f"{r}.doc_id")) & (F.col(f"{l}.h") == F.col(f"{r}.h"))
    quarter = F.floor(F.col("o.n") / 4).cast("int")
    heads = (
        base.alias("b")
        .join(order.alias("o"), F.col("b.doc_id").eqNullSafe(F.col("o.next_id")) & (F.col("b.h") == F.col("o.next_h")))
        .select("o.doc_id", "o.h", (F.col("o.n").cast("int") - quarter).alias("stay"), F.substring(F.col("b.body"), F.lit(1), quarter).alias("head"))
    )
    both = base.alias("b").join(heads.alias("e"), mine("b", "e")).select(
        "b.doc_id", "b.h", F.col("body"), F.concat(F.substring(F.col("body"), F.lit(1), F.col("stay")), F.col("head")).alias("edited")
    )
    stacked = both.select("doc_id", "h", F.explode(F.array(F.struct(F.lit(0).alias("w"), F.col("body").alias("t")), F.struct(F.lit(1).alias("w"), F.col("edited").alias("t")))).alias("x"))
    whole = stacked.select("doc_id", "h", "x.w", F.when(F.col("x.w") == 1, F.sha2("x.t", 256)).alias("sha"), F.col("x.t").alias("t"))
    fps = fingerprints(whole, ["doc_id", "h", "w", "sha"], "t")
    side = lambda w, c: F.max(F.when(F.col("w") == w, F.col(c)))
    each = cut(fps.groupBy("doc_id", "h").agg(side(0, "fp").alias("fp"), side(1, "fp").alias("efp"), side(1, "sha").alias("sha")))
    rows = order.alias("o").join(each.alias("m"), mine("o", "m")).select("o.*", "m.fp", "m.efp", "m.sha")
    following = each.select(F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"), F.col("fp").alias("next_fp")).alias("x")
    rows = rows.alias("r").join(following, F.col("r.next_id").eqNullSafe(F.col("x.next_id")) & (F.col("r.next_h") == F.col("x.next_h"))).select("r.*", "next_fp")
    asked = F.col("doc_id") % 20 == 0
    classes = rows.groupBy("fp").agg(F.sum("copies").alias("docs"), F.max(asked).alias("asked"))
    classes = cut(classes)
    found = within_radius(classes.where("asked").select(F.col("fp").alias("q")), classes.select("fp"), radius)
    n_within = found.join(classes.select("fp", "docs"), "fp").groupBy("q").agg(F.sum("docs").alias("n"))
    out = rows.join(n_within, rows.fp == n_within.q, "left")
    return out.select(
        F.col("doc_id").alias(key),
        rows["n"].alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        text_of(F.col("fp")).alias("fingerprint"),
        text_of(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked, n_within["n"] - 1).alias("n_within"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy"),
    ).drop("__copy")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: fingerprints of `documents`, whole table and whole texts, and of their edited texts."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))
