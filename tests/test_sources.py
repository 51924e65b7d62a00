from beaconframe.operators import detector, normalize
from beaconframe.sources import files
from beaconframe.streaming import outbox


def _put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_delimited(spark, tmp_path):
    path = _put(tmp_path, "t.csv", 'a,b\n1,x\n2\n3,y,z\n4,\n5,q,\n,"u,v"\n')
    rows = files.read_delimited(spark, path)
    assert [tuple(r) for r in rows.collect()] == [("1", "x"), ("2", None), ("4", None), (None, "u,v")]
    assert [r[0] for r in rows.select("b").collect()] == ["x", None, None, "u,v"]
    files.write_delimited(rows, str(tmp_path / "out"))
    assert sorted(map(str, files.read_delimited(spark, str(tmp_path / "out")).collect())) == sorted(map(str, rows.collect()))


def test_delimited_quotes(spark, tmp_path):
    path = _put(tmp_path, "q.csv", 'a,"b ""c"""\n1,"x, ""y"""\n2,"back\\slash"\n3\n4,"p","q"\n')
    rows = files.read_delimited(spark, path)
    assert rows.columns == ["a", 'b "c"'] and [tuple(r) for r in rows.collect()] == [("1", 'x, "y"'), ("2", "back\\slash"), ("3", None)]


def test_json(spark, tmp_path):
    lines = files.read_json(spark, _put(tmp_path, "a.json", '{"n": 1, "p": {"q": "x"}}\n{"n": 2, "p": null}\n'))
    assert lines.columns == ["n", "p.q"] and [tuple(r) for r in lines.collect()] == [(1, "x"), (2, None)]
    array = files.read_json(spark, _put(tmp_path, "b.json", '[\n {"n": 1},\n {"n": 2}\n]'))
    assert [r[0] for r in array.collect()] == [1, 2]
    assert files.read_json(spark, _put(tmp_path, "c.json", '{\n "n": 7\n}')).collect()[0][0] == 7
    files.write_json(lines, str(tmp_path / "out"))
    assert sorted(r["n"] for r in spark.read.json(str(tmp_path / "out")).collect()) == [1, 2]


def test_calls_and_domains(spark, tmp_path):
    path = _put(tmp_path, "t.sc", "1631222507704088918 0 20940 apache2 20940 clone < res=31 exe=apache2\n\nbad line\n1 0 2 p 3 read >\n")
    rows = files.read_calls(spark, path).collect()
    assert [r["syscall"] for r in rows] == ["clone", "read"] and rows[0]["raw_args"] == "res=31 exe=apache2" and rows[1]["raw_args"] is None
    names = files.read_domains(spark, _put(tmp_path, "x_domains.csv", "google.com\n, a.org,b\n\n ,\n"))
    assert [r[0] for r in names.collect()] == ["google.com", "a.org"]


def test_published_messages_after_a_restart(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, "consumer string, message_id bigint, body string").write.mode("append").parquet(f"{tmp_path}/{name}")

    def run():
        stream = spark.readStream.schema("consumer string, message_id bigint, body string").parquet(f"{tmp_path}/out")
        outbox.publish(spark, stream, f"{tmp_path}/sent", f"{tmp_path}/state").awaitTermination()
        return sorted((r.consumer, r.message_id) for r in spark.read.parquet(f"{tmp_path}/sent").collect())

    put("out", [("a", 1, "x"), ("a", 1, "again"), ("b", 1, "y")])
    assert run() == [("a", 1), ("b", 1)] == run()
    put("out", [("a", 1, "later"), ("a", 2, "z")])
    assert run() == [("a", 1), ("a", 2), ("b", 1)]


def test_detections_and_normalized_events(spark, tmp_path):
    scored = spark.createDataFrame([(0, "e", 0.7, 1, *[0.5] * 4)], "row_index bigint, entity_id string, fusion double, predicted int, " + ", ".join(f"{b} double" for b in detector.BRANCHES))
    for job in ("j1", "j2"):
        detector.write_detections(scored, f"{tmp_path}/d", job)
    assert sorted((r.job, r.score) for r in spark.read.parquet(f"{tmp_path}/d").collect()) == [("j1", 0.7), ("j2", 0.7)]
    rows = spark.createDataFrame([("2026-01-01T00:00:00Z", 1), ("never", 2), (None, 3)], "event_ts string, n int")
    normalize.write_normalized(rows, {}, f"{tmp_path}/n")
    assert [r.event_ts is None for r in normalize.read_normalized(spark, f"{tmp_path}/n").orderBy("n").collect()] == [False, True, True]
