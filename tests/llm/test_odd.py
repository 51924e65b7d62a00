"""All operators on nulls, empty and long texts, repeated rows, empty tables and columns of the names that they use themselves."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import beaconframe.llm
from beaconframe.llm import dedup_exact, html_text, jaccard_join, line_dedup, packing, pieces, quality, simhash, toxicity, warc

LONG = " ".join(f"word{i % 977}" for i in range(30000))
S = "alpha beta gamma delta epsilon zeta. eta theta"
TEXTS = [(1, S), (1, S), (None, None), (None, ""), (2, None), (3, ""), (4, "   \n\n "), (5, LONG), (6, LONG + " more"), (7, "\U0001f600 é\u0000 z퟿"), (None, LONG), (8, S.replace("alpha", "ALPHA")), (40, "a\nb\na\nc")]
OWN = {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html"}
#: Each name that a module of the subpackage writes out, as further columns.
NAMES = sorted({n for f in Path(beaconframe.llm.__file__).parent.glob("*.py") for n in re.findall(r'"([a-z_][a-z_0-9]*)"', f.read_text(encoding="utf-8"))} - OWN)


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(k, t, None if k == 2 else "en", None if k == 6 else "s", None if k == 3 else 1) for k, t in TEXTS], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return rows.select("*", *[F.lit(f"extra {n}").alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "u", S), (1, "u", S), (None, None, None), (None, "x", LONG), (2, None, LONG), (3, "u3", LONG), (4, "", "<" * 3000), (5, "é\r\nx: y", "")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").select("*", *[F.lit(f"extra {n}").alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (3, 0, 1), (8, 1, 0), (5, 0, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int")


def _keys(rows):
    return Counter(r["doc_id"] for r in rows)


KEYS = Counter(k for k, _ in TEXTS)


def test_exact_dedup(docs):
    rows = dedup_exact.exact_dedup(docs).collect()
    assert _keys(rows) == KEYS and {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id in (1, 2, 3, 5, 8)} == {(1, 8, 3, False), (2, 3, 4, False), (3, 3, 4, True), (5, 5, 2, True), (8, 8, 3, True)}
    assert dedup_exact.exact_dedup(docs.limit(0)).count() == 0


def test_simhash(docs):
    rows = simhash.fingerprint_documents(docs).collect()
    prints = {t: {r.fingerprint for r in rows if r.doc_id == k} for k, t in TEXTS if k}
    assert _keys(rows) == KEYS and prints[S] == prints[S.replace("alpha", "ALPHA")] and prints[None] == prints[""] and all(len(p) == 1 for p in prints.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows) and {r.n_chars for r in rows if r.doc_id == 7} == {len("\U0001f600 é\u0000 z퟿")}
    assert simhash.fingerprint_documents(docs.limit(0)).count() == 0


def test_jaccard_join(docs):
    rows = jaccard_join.similarity_join(docs).collect()
    assert _keys(rows) == KEYS and {(r.doc_id, r.class_id, r.n_links) for r in rows if r.doc_id in (1, 2, 5, 6, 8)} == {(1, 1, 2), (2, 2, 0), (5, 5, 2), (6, 5, 2), (8, 1, 2)}
    kept = jaccard_join.one_of_each(docs)
    # of S, LONG, null, "", blanks, the emoji's text and the lines one row each
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 40]
    assert kept.select("rid" if "rid" in NAMES else NAMES[0]).distinct().count() == 1
    empty = jaccard_join.one_of_each(docs.limit(0))
    assert empty.columns == docs.columns and empty.count() == 0 == jaccard_join.similarity_join(docs.limit(0)).count()


def test_packing(docs):
    rows = packing.pack(docs).collect()
    assert set(_keys(rows)) == set(KEYS) and sum(r.length for r in rows if r.doc_id == 2) == 1 and all(r.length > 0 for r in rows)
    assert {r.doc_tokens for r in rows if r.doc_id == 5} == {sum(r.length for r in rows if r.doc_id == 5)}
    assert packing.pack(docs.limit(0)).count() == 0


def test_line_dedup(docs):
    out = line_dedup.drop_boilerplate(docs)
    assert set(out.columns) == set(docs.columns) | {"n_lines", "n_dropped"} and _keys(out.collect()) == KEYS and all(r.text is None for r in out.collect() if r.doc_id == 2)
    same = line_dedup.without_boilerplate(docs)
    assert same.columns == docs.columns and same.count() == len(TEXTS) and line_dedup.without_boilerplate(docs.limit(0)).count() == 0


def test_pieces(docs):
    rows = pieces.decode(pieces.encode(docs)).collect()
    kept = Counter((r.doc_id, r.text) for r in rows)
    assert kept == Counter(TEXTS) and pieces.decode(pieces.encode(docs.limit(0))).count() == 0


@pytest.mark.parametrize(("module", "keep"), [(toxicity, toxicity.reject_toxic), (quality, quality.keep_good)])
def test_classifiers(docs, labels, module, keep):
    model = module.train(docs, labels)
    scored = module.score(docs, model, ["doc_id", "lang"]).collect()
    assert _keys(scored) == KEYS and all(0 <= r.score <= 1 for r in scored)
    left = keep(docs, model)
    assert left.columns == docs.columns and _keys(left.collect()) <= KEYS
    assert keep(docs, module.train(docs, labels.limit(0))).count() == len(TEXTS) and keep(docs.limit(0), module.train(docs.limit(0), labels)).count() == 0


def test_html(pages):
    rows = html_text.main_text(pages, ["page_id", "url", *NAMES[:20]]).collect()
    assert Counter(r.page_id for r in rows) == Counter({1: 2, None: 2, 2: 1, 3: 1, 4: 1, 5: 1}) and all(r.text is not None and r.n_chars == len(r.text) for r in rows)
    assert html_text.main_text(pages.limit(0), ["page_id"]).count() == 0


def test_warc(spark, pages, tmp_path):
    warc.write_warc(pages, f"file://{tmp_path}/w")
    rows = warc.read_warc(spark, f"file://{tmp_path}/w").collect()
    assert len(rows) == 8 and {(r.page_id, r.record_type, r.refers_to) for r in rows if r.page_id in (2, 3)} == {(2, "revisit", 3), (3, "response", None)}
    assert {r.payload_bytes for r in rows if r.page_id == 5} == {0}
    warc.write_warc(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read_warc(spark, f"file://{tmp_path}/none").count() == 0
