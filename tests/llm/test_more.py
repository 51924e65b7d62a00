"""Brute-force versions, exact covers and odd rows of the other operators."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconframe.llm import dedup_exact, jaccard_join, line_dedup, packing, pieces, simhash
from beaconframe.session import table
from test_llm import ROWS, SCHEMA, text


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3, "z", "s", 4, 5) for r in ROWS], SCHEMA)


def _sets(texts):
    h = jaccard_join._Hashes()
    return [frozenset(jaccard_join.shingles(t, h).tolist()) for t in texts]


def _brute(rows, similarity=0.8):
    """(key, class_id, n_links) of each row."""
    sets = _sets([t for _, t in rows])
    groups = defaultdict(list)
    for k, s in enumerate(sets):
        groups[s].append(k)
    distinct = [s for s in groups if s]
    holds = defaultdict(list)
    for k, s in enumerate(distinct):
        for x in s:
            holds[x].append(k)
    near = []
    for k, s in enumerate(distinct):
        common = Counter(j for x in s for j in holds[x])
        near.append([j for j, c in common.items() if j != k and c >= similarity * (len(s) + len(distinct[j]) - c) - 1e-9])
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, js in enumerate(near):
        for b in js:
            root[find(a)] = find(b)
    least = {}
    for k, s in enumerate(distinct):
        ids = [rows[i][0] for i in groups[s] if rows[i][0] is not None]
        least[find(k)] = min([*ids, *([least[find(k)]] if least.get(find(k)) is not None else [])], default=None)
    out = Counter((rows[i][0], rows[i][0], 0) for i in groups.get(frozenset(), []))
    for k, s in enumerate(distinct):
        for i in groups[s]:
            out[(rows[i][0], least[find(k)], len(groups[s]) - 1 + sum(len(groups[distinct[j]]) for j in near[k]))] += 1
    return out


def test_jaccard_join_on_the_whole_table(spark):
    documents = table(spark, "/root/testdata/sf0.1", "documents")
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.similarity_join(documents).collect())
    want = _brute(rows)
    assert sum((want - got).values()) <= 0.002 * sum(n for _, _, n in want.elements()) and sum(got.values()) == len(rows)


def test_jaccard_join_of_a_hot_group(spark, monkeypatch):
    """Over 512 sets around one text, of all degrees of change, beside others that share half of it."""
    rng = np.random.default_rng(3)
    base = text(77, 160).split()
    rows = []
    for k in range(640):
        words = list(base)
        for at in rng.integers(0, 160, int(rng.integers(0, 7))):
            words[at] = f"w{rng.integers(0, 5)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(base[:90]) + " " + text(5000 + k, 90)) for k in range(300)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (2000, "word " * 400_000 + text(1, 50)), (2001, "word " * 400_000 + text(1, 50) + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = _brute(rows)
    for block, weight in ((jaccard_join.BLOCK, jaccard_join.WEIGHT), (40, 5_000)):  # the second: blocks of all kinds
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        monkeypatch.setattr(jaccard_join, "APART", block)
        monkeypatch.setattr(jaccard_join, "WEIGHT", weight)
        assert Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.similarity_join(docs).collect()) == want


def test_jaccard_join_leaves_no_files_of_empty_tasks(spark):
    """Over many shuffle partitions that Spark does not join by size, tasks follow the rows, not the levels of the trees."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(f"x{k}" if j == at else w for j, w in enumerate(base))) for k, at in enumerate(rng.integers(0, 120, 600).tolist())]
    rows += [(600 + k, " ".join(f"v{x}" for x in rng.integers(0, 3000, 40).tolist())) for k in range(600)]
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    were = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few tasks", "")
        found = Counter(map(tuple, jaccard_join.similarity_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in were.items():
            spark.conf.set(k, v)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few tasks") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    assert found == _brute(rows)
    assert 0 < tasks < 3500, tasks


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(40)] + [(90, 60), (61, 90), (60, 60)]
    got = {r.rid: r.least for r in jaccard_join.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 60: 60, 61: 60, 90: 60}


def test_one_of_each_decides_by_row(spark):
    a, b = text(1), text(2)
    rows = [(None, a), (None, b), (None, b), (5, a), (7, a + " more"), (8, None), (9, None), (10, ""), (10, ""), (11, text(3)), (11, text(3)), (11, text(4))]
    docs = spark.createDataFrame([(*r, k % 2, "x") for k, r in enumerate(rows)], "doc_id bigint, text string, class int, `_i` string")
    out = jaccard_join.one_of_each(docs)
    assert out.schema == docs.schema
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(5, a), (None, b), (8, None), (10, ""), (11, text(3)), (11, text(4))])
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0


def test_simhash_values_by_brute_force(spark, docs):
    """Votes counted in Python from the same term hashes."""
    whole = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", F.when(F.col("doc_id") == 9, F.lit("long words " * 40_000)).otherwise(F.col("text")).alias("text"))
    src = sorted((r.doc_id, r.text or "") for r in whole.collect())
    edited = {d: t[: len(t) - len(t) // 4] + src[(k + 1) % len(src)][1][: len(t) // 4] for k, (d, t) in enumerate(src)}
    both = spark.createDataFrame([(d, 0, t) for d, t in src] + [(d, 1, t) for d, t in edited.items()], "d bigint, w int, t string")

    def fingerprint(hashes):
        votes = [sum(1 if h >> k & 1 else -1 for h in hashes) for k in range(64)]
        return sum(1 << k for k, v in enumerate(votes) if v > 0)

    fp = {(r.d, r.w): fingerprint(r.h) for r in both.select("d", "w", simhash.terms(F.col("t")).alias("h")).collect()}
    like = lambda a, b: 1 - bin(a ^ b).count("1") / 64
    for k, r in enumerate(simhash.fingerprint_documents(whole).orderBy("doc_id").collect()):
        d, after = src[k][0], src[(k + 1) % len(src)][0]
        near = sum(bin(fp[d, 0] ^ fp[e, 0]).count("1") <= simhash.RADIUS for e, _ in src) - 1 if d % 20 == 0 else None
        assert (r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next, r.n_within) == (d, f"{fp[d, 0]:016x}", f"{fp[d, 1]:016x}", like(fp[d, 0], fp[d, 1]), like(fp[d, 0], fp[after, 0]), near)
    with pytest.raises(ValueError, match="radius"):
        simhash.within_radius(both, both, 6)


def _covers(rows, want, tiers):
    """Each id in exactly one piece, sequences without gaps and of a power of two, groups of equal tokens."""
    spans, sequences, groups = defaultdict(list), defaultdict(list), defaultdict(dict)
    for r in rows:
        spans[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        groups[r.step_group, r.step_tokens][r.sequence_id] = r.sequence_tokens
    for doc, total in want.items():
        at = 0
        for start, length in sorted(spans.pop(doc)):
            assert start == at
            at += length
        assert at == total
    assert not spans
    for parts in sequences.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:k]) for k, (o, _) in enumerate(parts))
        total = sum(n for _, n in parts)
        assert total & (total - 1) == 0 and total <= tiers[0]
    assert all(sum(g.values()) == tokens for (_, tokens), g in groups.items())
    return sequences, groups


def test_packing_covers_each_id_once(spark):
    import public_tokenizers

    documents = table(spark, "/root/testdata/sf0.01", "documents")
    tok = packing.IdEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tok.encode(r.text or "")) + 1 for r in documents.collect()}
    for tiers in (packing.TIERS, (1024, 64)):
        _covers(packing.pack(documents, tiers=tiers).collect(), want, tiers)
    odd = ["", "a <|endoftext|> b", "日本 é\u0000 \n\n  x", "word " * 100_000, *(t for _, t in ROWS if t)]
    assert all(tok.encode(t).tolist() == tok.whole.encode(t, add_special_tokens=False).ids for t in odd)


def test_step_groups_are_balanced():
    rng = np.random.default_rng(1)
    packer = packing.Packer(5 << 40, pool_tokens=1 << 16, step_tokens=1 << 13)
    want = {}
    for k in range(3000):
        ids = np.arange(int(rng.integers(1, 3000)), dtype=np.uint32)
        want[k] = len(ids)
        packer.add(k, ids)
    packer.pack(last=True)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group", "step_tokens"]
    rows = [type("R", (), dict(zip(names, r, strict=True))) for r in packer.drain()]
    _, groups = _covers(rows, want, packing.TIERS)
    whole = [g for g, tokens in groups if tokens == 1 << 13]
    assert len({g for g, _ in groups}) == len(groups) == len(whole) + (len(whole) < len(groups)) and min(g for g, _ in groups) >= 5 << 40
    cost = Counter()
    for r in rows:
        cost[r.step_group] += r.length**2
    values = [cost[g] for g in whole]
    assert np.std(values) < 0.25 * np.mean(values)


def test_dropout_by_rounds_is_that_of_the_agenda():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, sp = pieces.model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    words = sorted({w for k in range(60) for w in text(k, 60).split()})[:700] + ["internationalisation", "ß", "日本語", "x" * 60]
    for dropout in (0.0, 0.1, 0.5):
        got = model.encode_all(words, list(range(len(words))), dropout=dropout)
        for d, w in enumerate(words):
            want, place = [], 0
            for place, part in enumerate(pieces._WORD.findall(" " + w)):
                key = pieces._mix(pieces._mix(np.array([d + pieces.SEED], np.uint64)) + np.array([place], np.uint64) * pieces._M1)
                ids = model.agenda(model.symbols([part]).tolist(), int(key[0]), dropout)
                want += [i for s in ids for i in ([s] if s >= 0 else [model.bytes[b] for b in chr(-2 - s).encode()])]
            assert got[d].tolist() == want
    plain = [text(k, 40) for k in range(100)] + ["a  b", "tab\tnew\nline", "Ünï"]
    assert [i.tolist() for i in model.encode_all(plain, list(range(len(plain))), dropout=0.0)] == sp.encode(plain)


def test_pieces_query_round_trip(spark):
    from beaconframe.llm import queries

    out = queries.QUERIES["op10_pieces"](spark, "/root/testdata/sf0.001")
    want = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = out.collect()
    assert all(r.lossless and r.decoded_sha256 == want[r.doc_id] for r in rows) and len(rows) == len(want)
    empty = spark.createDataFrame([], "doc_id bigint, text string, ids int")
    assert pieces.encode(empty).count() == 0 and pieces.decode(pieces.encode(empty)).count() == 0
    long_ = spark.createDataFrame([(1, "a long text " * 50_000), (1, "a long text " * 50_000)], "doc_id bigint, text string")
    assert [r.text for r in pieces.decode(pieces.encode(long_)).collect()] == ["a long text " * 50_000] * 2


def test_exact_dedup_with_a_full_filter(spark):
    rows = [(k, f"text {k % 700}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in dedup_exact.exact_dedup(docs, max_slots=1 << 16).collect()}
    of = defaultdict(list)
    for d, t in rows:
        of[t].append(d)
    assert got == {d: (max(of[t]), len(of[t]), d == max(of[t])) for d, t in rows}
    assert dedup_exact.false_share(1_000_000) < 0.01 < dedup_exact.false_share(10**10)


def test_line_dedup_of_small_sites_and_clashing_names(spark, monkeypatch):
    rows = [(1, "Menu\none", "a"), (2, "Menu\ntwo", "a"), (3, "three", "a"), (4, "only page\nof its site", "b"), (5, "N\nx", None), (6, "N\ny", None), (6, "N\ny", None), (7, "", "c"), (8, None, "c"), (9, "line\n" * 50_000, "d")]
    docs = spark.createDataFrame([(*r, 1, 2, "s", 3) for r in rows], "doc_id bigint, text string, source string, `__drop` int, stays int, site string, n_lines int")
    want = Counter([(1, "one"), (2, "two"), (3, "three"), (4, "only page\nof its site"), (5, "x"), (6, ""), (6, ""), (7, ""), (8, None), (9, "line\n" * 50_000)])
    for most in (line_dedup.BROADCAST_LINES, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", most)
        out = line_dedup.drop_boilerplate(docs)
        assert Counter((r.doc_id, r.text) for r in out.collect()) == want
        assert line_dedup.without_boilerplate(docs).columns == docs.columns


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, text(1), "en", "a", 3), (1, text(1), "en", "a", 3), (None, text(2), None, None, None), (4, None, "en", "a", 0), (5, "", "en", "b", 0), (6, "w " * 200_000 + text(9), "en", "b", 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines string, score int")
    spark.createDataFrame([(1, 1, 0), (6, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0, name
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns, name
        assert out.count() == {"n-gram Jaccard join": 5, "packing": out.count()}.get(name, 6), name


def test_pipeline_against_its_parts(spark):
    """Each stage by a plain version of its rule, on the smallest table."""
    import corpus_pipeline

    from beaconframe.llm import quality, toxicity

    sf = "/root/testdata/sf0.001"
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    bad, good = toxicity.train(documents, labels), None
    rows = [r for r in documents.collect() if toxicity.noisy_or(toxicity.sentence_logits(r.text or "", toxicity._Weights(bad), bad.bias)) < 0.5]
    good = quality.train(spark.createDataFrame(rows, documents.schema), labels)
    rows = [r for r in rows if good.probability(quality.indicators(r.text or "", quality._Hashes())) >= quality.THRESHOLD]
    pages, having = defaultdict(set), defaultdict(Counter)
    for r in rows:
        pages[r.source].add(r.text)
    for s, texts in pages.items():
        for t in texts:
            having[s].update({x.strip(" ") for x in (t or "").split("\n") if x.strip(" ")})
    cut = lambda r: r.text and "\n".join(x for x in r.text.split("\n") if not x.strip(" ") or having[r.source][x.strip(" ")] < 2 or having[r.source][x.strip(" ")] <= 0.1 * len(pages[r.source]))
    texts = [(r.doc_id, cut(r)) for r in rows]
    kept, empty = {}, {}
    for d, c, _ in _brute([t for t in texts if _sets([t[1]])[0]]):
        kept[c] = c
    for d, t in texts:
        if not _sets([t])[0]:
            empty[t] = min(d, empty.get(t, d))
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in out} == set(kept) | set(empty.values())
    sums = Counter()
    for r in out:
        sums[r.doc_id] += r.length
    assert all(sums[r.doc_id] == r.doc_tokens for r in out) and zlib.crc32(b"") == 0
