"""Small tests of the training-data operators: nulls, empty texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from beaconframe.llm import dedup_exact, html_text, jaccard_join, line_dedup, packing, pieces, quality, simhash, toxicity, warc

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def text(seed: int, n: int = 120) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{w}{k}" for w, k in zip(rng.choice(WORDS, n), rng.integers(0, 50, n), strict=True))


ROWS = [(1, text(1)), (2, text(1).upper()), (3, None), (4, ""), (5, text(2) + " more"), (6, text(2)), (6, text(2)), (None, text(3)), (8, "Ünï " * 3000), (9, "one two"), (10, "one two")]
SCHEMA = "doc_id bigint, text string, hash int, score string, text_sha256 string, n int, size int, kept string, source string, fp int, rid int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3, "z", "s", 4, 5) for r in ROWS], SCHEMA)


def test_exact_dedup(docs):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in dedup_exact.exact_dedup(docs).collect())
    want = Counter()
    for d, t in ROWS:
        same = [e for e, u in ROWS if low(u) == low(t)]
        keep = max((e for e in same if e is not None), default=None)
        want[(d, keep, len(same), d == keep, hashlib.sha256(low(t).encode()).hexdigest())] += 1
    assert got == want
    assert dedup_exact.exact_dedup(docs.limit(0)).count() == 0


def test_bloom_filter_has_no_false_negatives():
    h = np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 5000)
    block, slots = dedup_exact._slots(np.r_[h, h[:100]], 3)
    counts = [dedup_exact._unpack(dedup_exact._pack(slots[block == b])) for b in range(3)]
    assert all((counts[b][s] > 1).all() for b, s in zip(block[:100], slots[:100], strict=True))


def test_packing_round_trip(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs).collect()
    want = Counter(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    assert sum(r.length for r in rows) == sum(k * v for k, v in want.items())
    ids = {d: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in ROWS}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for s in {r.sequence_id for r in rows}:
        mine = sorted((r.offset, r.length) for r in rows if r.sequence_id == s)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]
        total = sum(n for _, n in mine)
        assert total & (total - 1) == 0 and total <= 2048
    assert packing.pack(docs.limit(0)).count() == 0


def test_warc_round_trip_and_rolling(spark, tmp_path):
    long_ = "é<p>" * 400
    rows = [(1, "http://a/ b", long_, 0), (2, None, long_, 0), (3, "u", None, 0), (4, "u", "", 0), (5, "u", "short", 0), (6, "u", "short", 0), (None, "u", long_, 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    one, two = (f"{tmp_path}/{k}" for k in "ab")
    manifest = warc.write_warc(pages, one, roll_bytes=200)
    assert len(manifest["files"]) > 2 and warc.write_warc(pages, two, roll_bytes=200) == manifest
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload) if r.payload is not None else None) for r in warc.read_warc(spark, one).collect()), key=lambda r: r[0])
    for (page, kind, to, size, digest, payload), (pid, _, h, _) in zip(got, sorted(rows, key=lambda r: r[0] or 0), strict=True):
        body = (h or "").encode()
        assert (page, size, digest) == (pid or 0, len(body), hashlib.sha1(body).hexdigest())
        assert (kind, to) == (("revisit", 2) if pid == 1 else ("response", None))
        assert payload == (None if kind == "revisit" else body)
    assert warc.read_warc(spark, f"{tmp_path}/a").count() == 7
    warc.write_warc(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def test_simhash_against_brute_force(docs):
    rows = simhash.fingerprint_documents(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).orderBy("doc_id").collect()
    src = sorted({d: t or "" for d, t in ROWS if d is not None}.items())
    for k, (r, (d, t)) in enumerate(zip(rows, src, strict=True)):
        n, nxt = len(t) // 4, src[(k + 1) % len(src)][1]
        assert (r.doc_id, r.n_chars) == (d, len(t)) and r.edited_sha256 == hashlib.sha256((t[: len(t) - n] + nxt[:n]).encode()).hexdigest()
    fp = {r.doc_id: r.fingerprint for r in rows}
    assert fp[1] == fp[2] and fp[3] == fp[4] == "0" * 16
    assert simhash.fingerprint_documents(docs).count() == len(ROWS)
    assert simhash.fingerprint_documents(docs.limit(0)).count() == 0


def test_simhash_search_is_exact(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 62), 1 << 62, 40).tolist()
    fps = sorted({b ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 6), replace=False)) for b in base for _ in range(8)})
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    got = Counter((r.q, r.fp, r.distance) for r in simhash.within_radius(df.selectExpr("fp as q").limit(50), df).collect())
    qs = {q for q, _, _ in got}
    want = Counter((a, b, d) for a in qs for b in fps if (d := bin((a ^ b) & (1 << 64) - 1).count("1")) <= 3)
    assert len(qs) == 50 and got == want


def test_line_dedup(spark):
    rows = [(i, f"Menu\nunique {i}\n\n Menu ", "a", 1) for i in range(8)] + [(9, None, "a", 1), (10, "", None, 1), (11, "Menu", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_lines int")
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(docs).collect()}
    assert out == {**{i: (f"unique {i}\n", 4, 2) for i in range(8)}, 9: (None, 0, 0), 10: ("", 1, 0), 11: ("Menu", 1, 0)}
    assert line_dedup.without_boilerplate(docs).columns == docs.columns
    assert line_dedup.drop_boilerplate(docs.limit(0)).count() == 0


def test_jaccard_join_against_brute_force(spark):
    rows = [(i, text(i % 12).replace("a", "a", 1) if i % 3 else text(i % 12) + f" tail{i}") for i in range(60)] + [(100, None), (101, ""), (102, "one two"), (103, "one two"), (103, "one two"), (None, text(1))]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.similarity_join(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, rid int, size int")).collect())
    h = jaccard_join._Hashes()
    sets = [set(jaccard_join.shingles(t, h).tolist()) for _, t in rows]
    near = [[j for j in range(len(rows)) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    want = Counter()
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        want[(d, min((rows[j][0] for j in seen if rows[j][0] is not None), default=None), len(near[i]))] += 1
    assert got == want
    assert jaccard_join.similarity_join(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_pieces(docs, spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.model(path)
    texts = [t for _, t in ROWS if t] + ["x" * 300 + " ▁y", "  a\n\tb 日本 "]
    plain = model.encode_all(texts[:-2], list(range(len(texts) - 2)), dropout=0.0)
    assert [p.tolist() for p in plain] == sp.encode(texts[:-2])
    a, b = (model.encode_all(texts, list(range(len(texts))), seed=s, dropout=0.3) for s in (1, 2))
    assert all(model.decode(x) == t and model.decode(y) == t for x, y, t in zip(a, b, texts, strict=True)) and any(len(x) != len(y) for x, y in zip(a, b, strict=True))
    back = pieces.decode(pieces.encode(docs)).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(ROWS)


def test_toxicity_and_quality():
    rng = np.random.default_rng(0)
    rows = [(text(k, 60).replace(" ", ". ", 3) + (" you vileword1 here." if k % 2 else ""), k % 2) for k in range(200)]
    model = toxicity.fit(rows)
    score = lambda t: toxicity.noisy_or(toxicity.sentence_logits(t, toxicity._Weights(model), model.bias))
    assert np.mean([(score(t) >= 0.5) == y for t, y in rows]) > 0.97
    t = text(999, 30) + ". Then vileword1 came. " + text(998, 30)
    assert [t[a:b].strip() for a, b, _ in toxicity.offending(t, model)] == ["Then vileword1 came."]
    assert score("") == 0 and toxicity.fit([]).weights == {}
    good = [(text(k, int(rng.integers(30, 90))), 1) for k in range(120)]
    bad = [(" ".join([w] * 20 for w in []) + "spam!! " * int(rng.integers(20, 60)), 0) for _ in range(80)]
    q = quality.fit(good + bad)
    p = [q.probability(quality.indicators(t, quality._Hashes())) for t, _ in good + bad]
    assert np.mean([(v >= 0.3) == y for v, (_, y) in zip(p, good + bad, strict=True)]) > 0.97
    assert quality.fit([]).probability(quality.indicators("", quality._Hashes())) > 0.9


def test_html():
    model = html_text.trained()
    page = "<html><body><nav class=menu><a href=/>Home</a> <a href=/b>News</a></nav><article><h1>A title</h1><p>First &amp; long paragraph, with words.<p>Second\n one here, with more words.</article><div class=ad>Buy it now.</div><footer>&copy; all rights</footer>"
    assert html_text.extract([page, "", "<p"], model) == ["A title\n\nFirst & long paragraph, with words.\n\nSecond one here, with more words.", "", ""]
    tree = html_text.parse(page)
    chosen = html_text.choose(tree, np.random.default_rng(1).normal(size=len(tree.tags)))
    assert all(p < 0 or not c or chosen[p] for c, p in zip(chosen, tree.parents, strict=True))


def test_pieces_are_drawn_for_each_place():
    import public_tokenizers

    model = pieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["international of " * 2000, text(5, 400) + " 日本 ▁y ab😀cd " + "internationalisation" * 3 + " counterrevolutionaries"] * 2
    got = model.encode_all(texts, [7, 8, 9, 8], dropout=0.1)
    assert got[1].tolist() == got[3].tolist() and got[0].tolist() != got[2].tolist()
    for k, d in ((0, 7), (1, 8), (2, 9)):  # each place by the plain form of the method, under its own key
        want = []
        for p, w in enumerate(pieces._WORD.findall(" " + texts[k])):
            key = pieces._mix(pieces._mix(np.array([d + pieces.SEED], np.uint64)) + np.array([p], np.uint64) * pieces._M1)
            ids = model.agenda(model.symbols([w]).tolist(), int(key[0]), 0.1)
            want += [i for s in ids for i in ([s] if s >= 0 else [model.bytes[b] for b in chr(-2 - s).encode()])]
        assert got[k].tolist() == want
    of = np.array([len(i) for i in (model.encode_all(["x of"], [d])[0] for d in range(2000))])  # one pair of merges leads to " of"
    assert 0.1 < (of > of.min()).mean() < 0.45
    forms = Counter(tuple(model.encode_all(["international"], [d], dropout=0.1)[0].tolist()) for d in range(300))
    assert len(forms) > 4


def test_pipeline_keeps_one_of_a_hot_copy_group(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    hot = "\n".join(text(900 + k, 40) for k in range(3))
    rows = [(k, hot, "a") for k in range(30)] + [(k, f"Menu\n{text(k)}", "a") for k in range(30, 70)] + [(k, "Menu" + "\n" * (k % 3), "a") for k in range(70, 90)]
    rows += [(k, ["", None, "--"][k % 3], "b") for k in range(90, 99)]
    spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {}
    for d, t, s in rows:
        pages = {u for _, u, v in rows if v == s}
        count = Counter(x for u in pages if u for x in {y.strip(" ") for y in u.split("\n")} if x)
        drop = {x for x, n in count.items() if n >= 5 and n > 0.1 * len(pages)}
        kept.setdefault(t if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in drop), d)  # the texts differ or are equal
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for t, d in kept.items()}
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == want and 0 in got and hot in kept


def test_html_keeps_text_after_empty_svg_and_of_math_and_xmp():
    model = html_text.trained()
    page = "<html><body><nav class=menu>%s<a href=/>Home</a> <a href=/b>News</a></nav><article><h1>A title</h1><p>First &amp; long paragraph, with words%s.<p>Second one here, with more words.%s</article><div class=ad>Buy it now.</div><footer>&copy; all rights</footer>"
    want = "A title\n\nFirst & long paragraph, with words%s.\n\nSecond one here, with more words."
    assert html_text.extract([page % ("<svg width='9'/>", "", ""), page % ("<svg/><math />", "", "<svg><text>no</text></svg>")], model) == [want % ""] * 2
    assert html_text.extract([page % ("", " <math><mi>x</mi><mo>+</mo><mi>y</mi></math>", "")], model) == [want % " x+y"]
    (got,) = html_text.extract([page % ("", "", "<xmp>a <b> &amp; c</xmp>")], model)
    assert got.startswith(want % "") and "a <b> &amp; c" in got
