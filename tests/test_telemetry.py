"""Sources, normalization, logs, editor, archives, detector and streaming on generated inputs; expected values by hand."""

import base64
import io
import json
import struct
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from beaconframe.functions import columns as C
from beaconframe.operators import core, detector, discovery, editor, lineage, logs, normalize, ordered
from beaconframe.sources import files, formats, packets
from beaconframe.streaming import flows

ROW = {"entity_id": "host-1", "event_ts": "2026-01-01T00:00:00", "feature_a": 1.0, "feature_b": 2.0, "label": 1}
HOST = normalize.Manifest(source_type="host")


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def one_row(spark, tmp_path, kind):
    head, values = list(ROW), [str(v) for v in ROW.values()]
    if kind == "parquet":
        spark.createDataFrame([ROW], "entity_id string, event_ts string, feature_a double, feature_b double, label bigint").write.parquet(f"{tmp_path}/x.parquet")
        return f"{tmp_path}/x.parquet"
    data = {
        "csv": lambda: "\n".join([",".join(head), ",".join(values)]),
        "tsv": lambda: "\n".join(["\t".join(head), "\t".join(values)]),
        "json": lambda: json.dumps([ROW]),
        "xlsx": lambda: formats.xlsx_bytes({"Sheet1": (head, iter([list(ROW.values())]))}),
    }[kind]()
    return put(tmp_path / f"x.{kind}", data)


@pytest.mark.parametrize("kind", ["csv", "tsv", "parquet", "xlsx", "json"])
def test_normalize_one_row_of_each_format(spark, tmp_path, kind):
    rows, report = normalize.normalize(spark, one_row(spark, tmp_path, kind), HOST)
    assert [r.asDict() for r in rows.collect()] == [{"entity_id": "host-1", "event_ts": "2026-01-01T00:00:00Z", "source_type": "host", "label": 1, "attack_stage": "suspicious_activity", "mitre_tactic": "TA0006", "feature_a": 1.0, "feature_b": 2.0}]
    assert report["row_count"] == 1 and report["format"] == kind and report["missing_values"] == 0 and report["warnings"] == []
    normalize.write_normalized(rows, report, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/events").count() == 1 and json.loads(spark.read.text(f"{tmp_path}/out/report").first()[0])["row_count"] == 1


def test_one_json_object_and_many_lines(spark, tmp_path):
    path = put(tmp_path / "one.json", json.dumps(ROW | {"label": 0, "event_ts": "2026-01-01T00:00:00Z"}, indent=1))
    assert [(r.entity_id, r.label) for r in normalize.normalize(spark, path, HOST)[0].collect()] == [("host-1", 0)]
    path = put(tmp_path / "two.ndjson", '{"name": "alice", "score": 1, "tags": ["a"]}\n{"name": "bob", "score": 2, "tags": ["a"]}')
    rows, report = normalize.normalize(spark, path, HOST)
    assert report["row_count"] == 2 and sorted(r.tags for r in rows.collect()) == ['["a"]'] * 2 and report["details"]["synthetic_timestamps_used"] == 2


def test_host_metrics_and_traces(spark, tmp_path):
    path = put(tmp_path / "sample.res", "timestamp,cpu_usage,memory_usage\n1631256556.235,0.25,19312640\n")
    rows, report = normalize.normalize(spark, path, HOST)
    assert [(r.entity_id, r.event_ts, r.label, r.cpu_usage) for r in rows.collect()] == [("sample-0", "2021-09-10T06:49:16Z", 1, 0.25)]
    assert report["warnings"] == ["Synthetic timestamps were used for rows without a parseable event timestamp.", "Labels were derived deterministically from the file name."]
    path = put(tmp_path / "benign.sc", "1631222507704088918 0 20940 apache2 20940 clone < res=31 exe=apache2 tid=20941 pid=20940\n\nbad line\n1 0 2 p 3 read >\n")
    rows = {r.entity_id: r for r in normalize.normalize(spark, path, HOST)[0].collect()}
    r = rows["apache2:20940"]
    assert (r.event_ts, r.res, r.exe, r.tid, r.label, r.attack_stage, r.syscall) == ("2021-09-09T21:21:47Z", 31, "apache2", 20941, 0, None, "clone")
    assert files.read_calls(spark, path, max_rows=1).count() == 1
    with pytest.raises(ValueError, match="no records"):
        formats.read(spark, put(tmp_path / "bad.sc", "only four fields here\n"))


def test_malformed_and_duplicate_rows_are_counted(spark, tmp_path):
    path = put(tmp_path / "heavy.csv", "Domain,T tl,T-tl\na.org,1,x\na.org,1,x\n,2,5\nb.org,3,6,7\nc.org\n")
    rows, report = normalize.normalize(spark, path)
    got = sorted((r.entity_id, r.t_tl, r.t_tl_2) for r in rows.collect())
    assert [g[0] for g in got] == ["a.org", "a.org", "c.org"] and report["duplicate_rows"] == 1 and report["dropped_rows"] == 1
    assert report["columns"][:6] == normalize.CORE and report["warnings"]


def test_column_names_and_profiles(spark, tmp_path):
    assert [normalize.column_name(x) for x in (" A-b..C ", "é", "x1__y")] == ["a_b_c", "unnamed", "x1_y"]
    assert formats.dedup_headers(["x", "", "x", None, "x"]) == ["x", "column_2", "x_2", "column_4", "x_3"]
    assert len(normalize.STATEFUL) == 27 and len(normalize.target_columns("dns_exf_stateful")) == 33 and len(normalize.target_columns("dns_exf_stateless")) == 20
    assert normalize.profile_of("x.csv", "csv", [c.upper() for c in normalize.STATEFUL]) == "dns_exf_stateful"
    assert normalize.profile_of("x.csv", "csv", normalize.STATELESS) == "dns_exf_stateless"
    assert normalize.profile_of("CSV_x.csv", "csv", ["a"]) == normalize.profile_of("y.csv", "csv", ["ip", "ttl", "asn", "domain", "entropy", "z"]) == "dns2021_tabular_features"
    found = normalize.inspect(spark, put(tmp_path / "x_domains.csv", 'google.com\n, "A.org",b\n\n'))
    assert found["supporting_only"] and found["schemas"] == ["dns-domain-intel"] and found["name"] == "x_domains-dataset"
    rows, report = normalize.normalize(spark, f"{tmp_path}/x_domains.csv")
    got = {r.entity_id: (r.domain_length, r.numeric_ratio, r.subdomain_depth, round(r.domain_entropy, 5), r.hyphen_count) for r in rows.collect()}
    assert got == {"google.com": (10, 0.0, 0, 2.64644, 0), "a.org": (5, 0.0, 0, 2.32193, 0)} and report["supporting_only"]
    with pytest.raises(formats.UnknownFormat):
        formats.detect_format(spark, put(tmp_path / "x.bin", b"1234"))
    with pytest.raises(normalize.ContractError, match="missing"):
        normalize.project(rows, normalize.FeatureSchema("s", ["no_such"]))
    with pytest.raises(normalize.ContractError, match="repeat"):
        normalize.FeatureSchema("s", ["a", "a"])


def test_numeric_share_and_epoch_units(spark):
    rows = spark.createDataFrame([(str(k) if k < 6 else "x", str(k) if k < 5 else "x") for k in range(10)], "a string, b string")
    out, invalid = normalize.coerce_numbers(rows, ["a", "b"])
    assert dict(out.dtypes) == {"a": "double", "b": "string"} and invalid == 4
    for unit in (1, 1000, 10**6, 10**9):
        df = spark.createDataFrame([(str(1631256556 * unit),), ("2021-09-10T06:49:16Z",), ("x",), (None,)], "t string")
        assert [str(r[0]) for r in df.select(C.iso_seconds(normalize.parsed_time(df, "t"))).collect()] == ["2021-09-10T06:49:16Z"] * 2 + ["None"] * 2


def dns_frame(name, answers=(), src=(10, 0, 0, 1), sport=5353):
    question = b"".join(bytes([len(x)]) + x.encode() for x in name.split(".")) + b"\0" + struct.pack(">HH", 1, 1)
    body = struct.pack(">6H", 1, 0x8180 if answers else 0x0100, 1, len(answers), 0, 0) + question + b"".join(b"\xc0\x0c" + struct.pack(">HHIH", code, 1, ttl, 4) + b"\1\2\3\4" for code, ttl in answers)
    udp = struct.pack(">HHHH", sport, 53, 8 + len(body), 0) + body
    return b"\0" * 12 + b"\x08\x00" + struct.pack(">BBHHHBBH4B4B", 0x45, 0, 20 + len(udp), 0, 0, 64, 17, 0, *src, 8, 8, 8, 8) + udp


def capture(frames, order="<"):
    return struct.pack(f"{order}IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1) + b"".join(struct.pack(f"{order}IIII", t // 10**6, t % 10**6, len(f), len(f)) + f for t, f in frames)


def capture_ng(frames):
    block = lambda kind, body: struct.pack("<II", kind, 12 + len(body) + -len(body) % 4) + body + b"\0" * (-len(body) % 4) + struct.pack("<I", 12 + len(body) + -len(body) % 4)
    head = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)) + block(1, struct.pack("<HHI", 1, 0, 65535) + struct.pack("<HHB3x", 9, 1, 9) + struct.pack("<HH", 0, 0))
    return head + b"".join(block(6, struct.pack("<IIIII", 0, t * 1000 >> 32, t * 1000 & 0xFFFFFFFF, len(f), len(f)) + f) for t, f in frames)


def test_captures_and_flows(spark, tmp_path):
    t = 1_700_000_000_000_000
    a, b = dns_frame("example.com", [(1, 60), (5, 30)]), dns_frame("aa.org")
    tcp = bytearray(a)
    tcp[23] = 6
    sent = [(t + 250_000, b), (t, a), (t + 10, bytes(tcp)), (t + 20, a[:30]), (t + 30, dns_frame("x.y", sport=99).replace(struct.pack(">HH", 99, 53), struct.pack(">HH", 99, 98))), (t + 2_000_000, dns_frame("b.c", src=(10, 0, 0, 2)))]
    for k, data in enumerate((capture(sent), capture(sent, ">"), capture_ng(sent))):
        path = put(tmp_path / f"benign{k}.{'pcapng' if k == 2 else 'pcap'}", data)
        rows = normalize.normalize(spark, path)[0].orderBy("event_ts").collect()
        assert [r.entity_id for r in rows] == ["10.0.0.1->8.8.8.8", "10.0.0.2->8.8.8.8"] and rows[0].asDict().keys() == {*normalize.CORE, *normalize.FLOW_MEASURES}
        r = rows[0]
        assert (r.event_ts, r.packet_count, r.byte_total, r.mean_inter_arrival_ms, r.query_rr_count, r.answer_rr_count, r.unique_qnames, r.rr_type_a, r.rr_type_cname, r.rr_type_other, r.ttl_mean, r.ttl_max, r.label) == ("2023-11-14T22:13:20Z", 2, len(a) + len(b), 250.0, 2, 2, 2, 1, 1, 0, 45.0, 60, 0)
        entropy = lambda s: spark.range(1).select(C.shannon_entropy(F.lit(s))).first()[0]
        assert r.dns_query_entropy_mean == pytest.approx((entropy("example.com") + entropy("aa.org")) / 2) and rows[1].ttl_max == 0 and rows[1].mean_inter_arrival_ms == 0
    assert formats.detect_format(spark, put(tmp_path / "noname", capture(sent))) == "pcap"
    with pytest.raises(normalize.ContractError):
        normalize.normalize(spark, put(tmp_path / "none.pcap", capture([])))
    with pytest.raises(ValueError, match="no packet"):
        list(packets.frames(b"abcd"))
    assert packets.dns_packet(b"") is None and packets._name(b"\xc0\x02\x01a\x00", 0)[0] == "a"
    with pytest.raises(ValueError, match="circle"):
        packets._name(b"\xc0\x00", 0)


def test_combined_training_table(spark):
    base = lambda e, y: (e, "2026-01-01T00:00:00Z", "host", y, None, "TA0006")
    core_ = "entity_id string, event_ts string, source_type string, label int, attack_stage string, mitre_tactic string"
    one = spark.createDataFrame([(*base("proc-1", 0), 0.5, "x")], f"{core_}, cpu_usage double, mixed string")
    two = spark.createDataFrame([(*base("proc-1", 1), 7, 3)], f"{core_}, memory_usage bigint, mixed int")
    rows, counts = normalize.training_table([normalize.prefix_entities(one, "archive-one"), two, one.limit(0)])
    assert rows.columns == [*normalize.CORE, "cpu_usage", "memory_usage", "mixed"] and counts == {"0": 1, "1": 1}
    assert [r.entity_id for r in rows.orderBy("label").collect()] == ["archive-one:proc-1", "proc-1"] and [r.mixed for r in rows.orderBy("label").collect()] == ["x", "3"]
    with pytest.raises(normalize.ContractError, match="two labels"):
        normalize.training_table([one])


LINES = {
    "backend/backend-2026-04-21.json.log": ['{"timestamp": "2026-04-21T10:00:00+00:00", "level": "INFO", "function": "seed_defaults", "message": "Seeded"}', "not-json", "", '{"timestamp": "2026-04-21T11:00:00Z", "level": "ERROR", "service": "backend", "function": "validate_dataset", "message": "Failed", "request": {"Authorization": "x", "a": [{"token": 1, "b": 2}]}, "error": {"type": "E", "message": "broken pipe"}}', "[1]"],
    "training-service/training-service-2026-04-22.json.log": ['{"timestamp": "2026-04-22T09:00:00Z", "level": "WARNING", "function": "run_training", "request": {"token": "t"}}'],
}


@pytest.fixture
def store(spark, tmp_path):
    for name, lines in LINES.items():
        put(tmp_path / "logs" / name, "\n".join(lines) + "\n")
    return f"{tmp_path}/logs"


def test_log_entries_redaction_and_search(spark, store):
    assert logs.list_services(spark, store) == ["backend", "training-service"]
    entries = logs.read_logs(spark, store)
    rows = {(r.service, r.line_number): r for r in entries.collect()}
    assert set(rows) == {("backend", 1), ("backend", 2), ("backend", 4), ("backend", 5), ("training-service", 1)}
    assert json.loads(rows["backend", 4].request) == {"Authorization": logs.HIDDEN, "a": [{"token": logs.HIDDEN, "b": 2}]}
    bad = rows["backend", 2]
    assert (bad.level, bad.function, bad.raw_line, bad.is_valid, bad.timestamp) == ("WARNING", "log_parser", "not-json", False, None) and not rows["backend", 5].is_valid
    find = lambda **w: sorted((r.service, r.line_number) for r in logs.matching(entries, logs.Search(**w)).collect())
    assert find(level="error") == find(error_text="PIPE") == find(function="VALID") == find(search="broken") == [("backend", 4)]
    assert find(date_from="2026-04-22") == [("backend", 2), ("backend", 5), ("training-service", 1)]
    assert find(time_from="09:30", time_to="10:30:00") == [("backend", 1)]
    assert find(services=["training-service"]) == [("training-service", 1)] and find(message="invalid") == [("backend", 2), ("backend", 5)]
    assert logs.read_logs(spark, store, date_from="2026-04-22").count() == 1 and logs.read_logs(spark, store, ["backend"]).count() == 4
    assert logs.read_logs(spark, store, ["none"]).count() == 0 and logs.day_of("backend-2026-04-21.json.log") == "2026-04-21"
    logs.write_logs(entries, f"{store}/../written")
    assert spark.read.json(f"{store}/../written").count() == 5
    again = logs.read_logs(spark, f"{store}/../written")
    fields = ["timestamp", "service", "level", "message", "request", "error"]
    said = lambda rows: sorted(repr([json.dumps(json.loads(r[c]), sort_keys=True) if c in ("request", "error") and r[c] else r[c] for c in fields]) for r in rows.collect())
    assert said(again) == said(entries) and logs.list_services(spark, f"{store}/../written") == ["backend", "training-service"]


def test_log_sink_with_odd_services(spark, tmp_path):
    rows = spark.createDataFrame([("2026-04-21T10:00:00Z", "a b+c%41", "x", '{"n": 1}'), ("2026-04-22T10:00:00Z", "plain", "y", "no json"), (None, "plain", "z", None)], "timestamp string, service string, message string, request string")
    logs.write_logs(rows, f"{tmp_path}/w")
    assert logs.list_services(spark, f"{tmp_path}/w") == ["a b+c%41", "plain"] and logs.list_services(spark, f"{tmp_path}/none") == []
    got = lambda **k: sorted((r.service, r.message, r.request) for r in logs.read_logs(spark, f"{tmp_path}/w", **k).collect())
    assert got() == [("a b+c%41", "x", '{"n": 1}'), ("plain", "y", "{}"), ("plain", "z", "{}")]
    assert got(date_from="2026-04-22") == [("plain", "y", "{}"), ("plain", "z", "{}")] and got(services=["a b+c%41"])[0][1] == "x"
    assert logs.read_logs(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_log_pages_reach_each_entry_once(spark, store, descending):
    entries = logs.read_logs(spark, store)
    seen, cursor = [], None
    while True:
        page = logs.page(entries, 2, cursor, descending)
        seen += [(r["timestamp"] or "", r["service"], r["line_number"]) for r in page["items"]]
        assert page["has_more"] == (page["next_cursor"] is not None) and page["invalid_rows"] == sum(not r["is_valid"] for r in page["items"])
        if not (cursor := page["next_cursor"]):
            break
    assert seen == sorted(seen, reverse=descending) and len(seen) == len(set(seen)) == 5
    assert logs.position_of("no cursor") is None and logs.position_of(None) is None and logs.position_of(base64.urlsafe_b64encode(b"[1]").decode()) is None
    with pytest.raises(ValueError, match="200"):
        logs.page(entries, 201)


def test_editor_session(spark, tmp_path):
    path = put(tmp_path / "t.csv", "name,score,when\nalice,1,2026-01-01\nbob,,\ncarol,3,2026-01-03\n")
    base = editor.open_rows(spark, path)
    assert editor.column_types(base) == {"name": "string", "score": "int", "when": "date"}
    patch = lambda *rows: spark.createDataFrame(list(rows), "row_index bigint, column string, value string, seq bigint")
    editor.check_cells(patch((0, "score", "5", 1), (1, "score", "", 1)), editor.column_types(base))
    for bad in (patch((0, "score", "x", 1)), patch((0, "none", "x", 1))):
        with pytest.raises(editor.EditorError):
            editor.check_cells(bad, editor.column_types(base))
    session = editor.Session(base, patch((0, "name", "a,b", 1), (1, "score", None, 1), (0, "score", "9", 1), (0, "score", "7", 2)), spark.createDataFrame([(2,)], "row_index bigint"))
    assert session.state(1) == {"rows": 2, "pending_cells": 3, "deleted_rows": 1, "pages": 2}
    assert session.page(1, 1) == [{"row_index": 0, "name": "a,b", "score": "7", "when": "2026-01-01"}]
    for number, size in ((3, 1), (0, 1), (1, 201)):
        with pytest.raises(editor.EditorError):
            session.page(number, size)
    with pytest.raises(editor.EditorError):
        session.hide(["name", "score", "when"])
    editor.save(session.hide(["when"]), path, "csv")
    assert open(path).read().splitlines() == ["name,score", '"a,b",7', 'bob,""'] or open(path).read().splitlines() == ["name,score", '"a,b",7', "bob,"]
    for kind in ("json", "parquet", "tsv", "xlsx"):
        editor.save(session, f"{tmp_path}/saved.{kind}", kind)
        back = formats.read(spark, f"{tmp_path}/saved.{kind}")
        assert [(r["name"], r["score"]) for r in back.collect()] == [("a,b", "7"), ("bob", None)]
    with pytest.raises(editor.EditorError):
        editor.save(session, path, "sc")
    with pytest.raises(editor.EditorError):
        editor.open_rows(spark, put(tmp_path / "nested.json", '{"a": [1]}\n{"a": [2]}'))
    kinds = spark.createDataFrame([("1", "true", "2026-01-01T00:00:00Z")], "a string, b string, c string")
    assert [r[0] for r in kinds.select(F.explode(F.array(*[editor.type_name(F.col(c)) for c in "abc"]))).collect()] == ["int", "bool", "datetime"]
    assert editor.as_json_array(spark.sql("select timestamp_ntz '2026-01-01 00:00:00' t, date '2026-01-02' d, null n")) == '[{"t": "2026-01-01T00:00:00.000000+00:00", "d": "2026-01-02", "n": null}]'


def test_xlsx_sheets(spark, tmp_path):
    data = formats.xlsx_bytes({"One": (["a"], iter([["<x>"], [None], [2.5], [True]])), "Two & more": (["b", "b"], iter([["y", 1]]))})
    path = put(tmp_path / "s.xlsx", data)
    assert [r.a for r in formats.read(spark, path).collect()] == ["<x>", None, "2.5", "true"]
    assert [tuple(r) for r in formats.read(spark, path, "Two & more").collect()] == [("y", "1")] and formats.headers(spark, path) == ["a"]


def archive_bytes(kind, content):
    out = io.BytesIO()
    if kind == "zip":
        with zipfile.ZipFile(out, "w") as z:
            for name, data in content.items():
                z.writestr(name, data)
    else:
        with tarfile.open(fileobj=out, mode=f"w:{kind}") as t:
            for name, data in content.items():
                entry = tarfile.TarInfo(name)
                entry.size = len(data)
                t.addfile(entry, io.BytesIO(data.encode()))
    return out.getvalue()


def test_archives_and_discovery(spark, tmp_path):
    content = {"d/sample.json": '{"exploit":false,"exploit_name":"default","container":[]}', "d/sample.res": "timestamp,cpu\n1,2\n", "d/sample.sc": "1 0 2 p 3 read >\n", "d/x.csv": "a\n1\n", "d/readme.txt": "no"}
    put(tmp_path / "in" / "host.zip", archive_bytes("zip", content))
    put(tmp_path / "in" / "net.tar.gz", archive_bytes("gz", {"a.csv": "a\n1\n", "b_domains.csv": "x\n"}))
    put(tmp_path / "in" / "other.txt", "x")
    members = formats.read_archives(spark, f"{tmp_path}/in")
    found = discovery.discover(members)
    rows = {(formats.name_of(r.archive), r.member): r for r in found.collect()}
    assert {k[1]: r.reason for k, r in rows.items()} == {"d/sample.json": "archive_metadata", "d/sample.res": None, "d/sample.sc": None, "d/x.csv": "ignored_for_host", "d/readme.txt": "unsupported_dataset_format", "a.csv": None, "b_domains.csv": "supporting_only"}
    assert rows["host.zip", "d/sample.sc"].label == 0 and rows["host.zip", "d/sample.sc"].source_type == "host" and rows["net.tar.gz", "a.csv"].label is None
    assert {(formats.name_of(r.archive), r.extracted, r.trainable, r.skipped) for r in discovery.summary(found).collect()} == {("host.zip", 5, 2, 3), ("net.tar.gz", 2, 1, 1)}
    assert discovery.voted_type(found) == "host"
    import gzip

    assert list(formats.members("x.csv.gz", gzip.compress(b"a"))) == [("x.csv", b"a")] and formats.detect_archive("A.TAR.GZ") == ".tar.gz" and formats.detect_archive("a.csv") is None
    for bad in ("../x", "/x", "a/../../x", "C:\\x", ".."):
        with pytest.raises(ValueError, match="unsafe"):
            formats.safe_path(bad)
    with pytest.raises(ValueError, match="unsafe"):
        list(formats.members("e.zip", archive_bytes("zip", {"../evil": "x"})))
    assert [r.name for r in formats.list_files(spark, f"{tmp_path}/in", archives=True).collect()] == ["host.zip", "net.tar.gz"]


def test_auto_schema(spark):
    rows = spark.createDataFrame([(f"e{k}", "t", "host", k % 2, None, "TA0006", 0.5 * k, k, "clone" if k % 2 else "read", f"args {k}", "/p", None) for k in range(4)], "entity_id string, event_ts string, source_type string, label int, attack_stage string, mitre_tactic string, cpu_usage double, memory_usage bigint, syscall string, raw_args string, path string, nothing string")
    schema = discovery.auto_schema(rows, "host", "auto")
    assert set(schema.required_columns) == {"cpu_usage", "memory_usage", "syscall"} and schema.feature_families == ["process", "sequence"]
    assert discovery.families_of(["x"], "network") == ["network_flow"]
    with pytest.raises(normalize.ContractError):
        discovery.auto_schema(rows.select(*normalize.CORE, "path"), "host", "none")


def training_rows(spark, n=120):
    return spark.createDataFrame([(f"e-{k // 10}", f"2026-01-01T00:{k // 60:02}:{k % 60:02}Z", "network", k % 2, "exfiltration" if k % 2 else None, "TA0011", k % 2, float(k), ["a", "b", None][k % 3]) for k in range(n)], "entity_id string, event_ts string, source_type string, label int, attack_stage string, mitre_tactic string, feature_a int, feature_b double, kind string")


def test_detector(spark, tmp_path):
    schema = normalize.FeatureSchema("s", ["feature_a", "feature_b", "kind"], "network", feature_families=["network_flow"], mitre_tactics={"x": "TA0011", "y": "TA0002", "z": "TA0011"})
    rows = training_rows(spark)
    bundle = detector.train(rows, schema, trees=10, rounds=5, depth=4)
    assert set(bundle.metrics) == {*detector.BRANCHES, "fusion"} and bundle.columns == ["feature_a", "feature_b", "kind_a", "kind_b", "kind_nan"]
    assert bundle.metrics["random_forest"]["f1"] > 0.9 and all(0 <= m["roc_auc"] <= 1 for m in bundle.metrics.values())
    detector.save(bundle, f"{tmp_path}/bundle")
    again = detector.load(spark, f"{tmp_path}/bundle")
    records = spark.createDataFrame([(1, 7.0, "a"), (0, 8.0, "new"), (0, 9.0, None)], "feature_a int, feature_b double, kind string")
    one, two = (detector.predict(b, records).collect() for b in (bundle, again))
    assert one == two and [r.row_index for r in one] == [0, 1, 2] and [r.predicted for r in one][0] >= [r.predicted for r in one][1]
    assert all(r.fusion == pytest.approx(sum(r[b] for b in detector.BRANCHES) / 4) for r in one) and one[0].top_features == ["feature_a", "feature_b", "kind"]
    told = detector.explain(again, records, 2).orderBy("row_index").first()
    assert len(told.positive) <= 2 and told.negative == [] and told.tactics == ["TA0002", "TA0011"] and told.feature_families == ["network_flow"]
    frame, columns = detector.training_frame(rows, schema)
    report = detector.cross_validation(frame, columns, trees=5, rounds=3)
    assert report["n_splits"] == 3 and len(report["folds"]) == 3 and detector.cross_validation(frame.where("label = 1"), columns)["folds"] == []
    fitted, held = detector.split(frame)
    assert (fitted.count(), held.count()) == (90, 30) and {r["label"]: r["count"] for r in held.groupBy("label").count().collect()} == {0: 15, 1: 15}
    for wrong in (rows.withColumn("source_type", F.lit("host")), rows.withColumn("label", F.lit(1)), rows.drop("feature_a"), rows.unionAll(rows.withColumn("source_type", F.lit("host")))):
        with pytest.raises(normalize.ContractError):
            detector.train(wrong, schema, trees=2, rounds=2)


def test_contributions_by_sign(spark):
    rows = spark.createDataFrame([(0, 0.9, -0.4, 0.4)], "k int, feature_a double, feature_b double, c double")
    r = detector.contributions(rows, {"feature_a": 1.0, "feature_b": 1.0, "c": 1.0}, "k", 1).first()
    assert [tuple(x) for x in r.positive] == [("feature_a", 0.9)] and [tuple(x) for x in r.negative] == [("feature_b", -0.4)]


def test_ordered_operations_cross_ranges(spark):
    rows = spark.createDataFrame([(k, "abc"[k * 3 // 5000], k if k % 1700 == 5 else None) for k in range(5000)], "k int, g string, v int").repartition(7)
    got = {r.k: r.v for r in ordered.fill(rows, "v", [], ["k"]).collect()}
    want, last = {}, None
    for k in range(5000):
        last = k if k % 1700 == 5 else last
        want[k] = last
    assert got == want
    got = {r.k: r.v for r in ordered.fill(rows, "v", ["g"], ["k"], -1).collect()}
    want, last = {}, {}
    for k in range(5000):
        g = "abc"[k * 3 // 5000]
        last[g] = k if k % 1700 == 5 else last.get(g, -1)
        want[k] = last[g]
    assert got == want
    ranks = {r.k: (r["rank"], r.n) for r in ordered.rank(rows, ["g"], ["k"], count="n").collect()}
    sizes = {g: sum("abc"[k * 3 // 5000] == g for k in range(5000)) for g in "abc"}
    assert all(ranks[k][1] == sizes["abc"[k * 3 // 5000]] for k in ranks) and all(ranks[k][0] - ranks[k - 1][0] == 1 for k in range(1, 1000))
    assert sorted(r.row_index for r in ordered.ordinal(rows).collect()) == list(range(5000))
    empty = rows.limit(0)
    assert ordered.fill(empty, "v", ["g"], ["k"]).count() == ordered.rank(empty, [], ["k"]).count() == ordered.ordinal(empty).count() == 0


def test_lineage(spark):
    d = spark.createDataFrame([(1, "a/x.csv", "validated"), (2, "b/y.csv", "validated"), (3, "a", "failed")], "id int, path string, status string")
    assert {r.id: r.status for r in lineage.invalidated(d, d.where("id = 1"), "path").collect()} == {1: "pending", 2: "validated", 3: "failed"}
    assert sorted(r.id for r in lineage.under(d, "path", "a/").collect()) == [1, 3] and lineage.chosen(d, "id", [1, 3]).count() == 2
    with pytest.raises(KeyError):
        lineage.chosen(d, "id", [1, 9])
    with pytest.raises(ValueError, match="length"):
        lineage.zipped(d.select("id"), d.limit(2).select("id", "status"), "id")
    m = spark.createDataFrame([(1, "pending", 0), (2, "pending", 9), (3, "pending", 8)], "id int, status string, attempts int").withColumn("available_at", F.lit("2026-01-01").cast("timestamp"))
    after = {r.id: (r.status, r.attempts, str(r.available_at)) for r in lineage.failed(m, "2026-01-02").withColumn("available_at", F.col("available_at").cast("string")).collect()}
    assert after == {1: ("pending", 1, "2026-01-02 00:00:02"), 2: ("failed", 10, "2026-01-01 00:00:00"), 3: ("pending", 9, "2026-01-02 00:01:00")}
    assert lineage.checked_sizes(d, "id", 6) == 6
    with pytest.raises(ValueError, match="more"):
        lineage.checked_sizes(d, "id", 5)
    stamped = d.withColumn("created_at", F.col("id"))
    assert [r.id for r in lineage.listed(stamped, "path").collect()] == [3, 1, 2] and [r.id for r in lineage.listed(stamped, "path", newest=True).collect()] == [3, 2, 1]


def test_stream_drops_repeated_messages(spark, tmp_path):
    rows = spark.createDataFrame([("c", k % 3, "2026-01-01T00:00:00") for k in range(9)], "consumer string, message_id int, at string").withColumn("at", F.col("at").cast("timestamp"))
    rows.write.parquet(f"{tmp_path}/m")
    stream = flows.undelivered_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/m"), "at")
    assert flows.drain(spark, stream, complete=False).count() == 3


def test_key_values_of_the_trace_form(spark):
    for text, want in {"-a=1 b=2": {"b": "2"}, "a=b=c  d=": {"a": "b=c", "d": ""}, "x y a=1 -z 2  b=3": {"a": "1 -z 2", "b": "3"}, "": {}, "a.b=1 c=2": {"c": "2"}, "a=1 a=2": {"a": "2"}}.items():
        assert spark.range(1).select(C.key_values(F.lit(text)).alias("m")).first().m == want
    assert core.column_profile(spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")).orderBy("column").collect()[1].asDict() == {"column": "b", "is_numeric": False, "non_null": 1, "n_distinct": 1, "max_length": 1, "score": 51}
