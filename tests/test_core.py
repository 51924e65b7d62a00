import duckdb
import pytest
from pyspark.sql import functions as F

from beaconframe.functions import columns as C
from beaconframe.operators import core as O
from beaconframe.plans import catalogue, round_trips

SF = "/root/testdata/sf0.001"


def test_entropy_and_domain(spark):
    row = spark.createDataFrame([("google.com",), ("",), (None,)], "s string").select("s", F.round(C.shannon_entropy(F.col("s")), 6).alias("e")).collect()
    assert [r.e for r in row] == [2.646439, 0.0, None]
    d = spark.createDataFrame([("a1.b-c.example.com",)], "s string").select(*[c.alias(k) for k, c in C.domain_features(F.col("s")).items()]).first()
    assert (d.length, d.depth, d.hyphens) == (18, 2, 1)


def test_key_values_last_wins(spark):
    m = spark.createDataFrame([("res=31 exe=apache2 res=7 note=a b c",)], "s string").select(C.key_values(F.col("s")).alias("m")).first().m
    assert m == {"res": "7", "exe": "apache2", "note": "a b c"}


def test_windows_pad_short_entities(spark):
    rows = spark.createDataFrame([("a", i, int(i == 1), float(i)) for i in range(3)] + [("b", i, 0, 1.0) for i in range(12)], "e string, t int, y int, v double")
    out = {(r.e, r.window_start): (r.label, r.rep, r.mean_v) for r in O.sequence_windows(rows, "e", ["t"], "y", "t", 5, 3, ["v"]).collect()}
    assert out == {("a", 0): (1, 2, (0 + 1 + 2 * 3) / 5), ("b", 0): (0, 4, 1.0), ("b", 3): (0, 7, 1.0), ("b", 6): (0, 10, 1.0)}


def test_auc_ties_and_single_class(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.9), (0, 0.1), (1, 0.8)], "y int, s double")
    assert O.roc_auc(rows, "y", "s").first().auc == 0.625
    assert O.roc_auc(rows.where("y = 1"), "y", "s").first().auc == 0.5


def test_overlay_null_overrides(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    patches = spark.createDataFrame([(1, "v", None, 1), (2, "v", "x", 1), (2, "v", "y", 2)], "k int, `column` string, value string, seq int")
    out = O.overlay(base, "k", patches, spark.createDataFrame([(3,)], "k int"), ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, None), (2, "y")]


@pytest.mark.parametrize("name", sorted(catalogue.SQL | round_trips.SQL))
def test_query_matches_sql(spark, name):
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages labels conversations".split():
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    norm = lambda rows: sorted(tuple("" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    df = (catalogue.QUERIES | round_trips.QUERIES)[name](spark, SF)
    cols = sorted(df.columns)
    expected = c.sql("select " + ", ".join(f'"{x}"' for x in cols) + f" from ({(catalogue.SQL | round_trips.SQL)[name]})").fetchall()
    assert norm(tuple(r) for r in df.select(*[F.col(f"`{x}`") for x in cols]).collect()) == norm(expected)
