"""The WARC writer: the same bytes for the same rows, ties, and what a reader refuses."""

import gzip
import io

import pytest

from beaconframe.llm import warc

LONG = "é<p>" * 400


def test_same_files_for_any_partitions_and_order(spark, tmp_path):
    rows = [(7, f"http://a/{k % 3}", LONG + str(k % 5), k) for k in range(40)] + [(k, "u", f"page {k} " * (k % 300), k) for k in range(500)] + [(None, None, LONG, 1)] * 3
    manifests = []
    for parts, order in ((3, 1), (7, -1), (1, 1)):
        pages = spark.createDataFrame(rows[::order], "page_id bigint, url string, html string, shard int").repartition(parts)
        manifests.append(warc.write_warc(pages, f"{tmp_path}/{parts}", shard_bytes=50_000))
    assert manifests[0] == manifests[1] == manifests[2] and len(manifests[0]["files"]) > 5
    back = warc.read_warc(spark, f"{tmp_path}/7")
    assert back.count() == len(rows) and back.where("page_id is null and record_type = 'response'").count() == 3
    with open(f"{tmp_path}/7/{manifests[0]['files'][0]['file']}", "rb") as f:
        (head, _), (first, _) = list(warc.records(f))[:2]
    assert head["WARC-Type"] == "warcinfo" and first["WARC-Type"] == "response"
    with pytest.raises(FileExistsError):
        warc.write_warc(pages, f"{tmp_path}/7")


def test_a_cut_or_changed_archive_raises(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"text {k}") for k in range(20)], "page_id bigint, url string, html string")
    manifest = warc.write_warc(pages, f"{tmp_path}/w")
    path = f"{tmp_path}/w/{manifest['files'][0]['file']}"
    data = open(path, "rb").read()
    member = data.rfind(b"\x1f\x8b\x08")
    assert len(list(warc.records(io.BytesIO(data[:member])))) == 20  # the boundary of a member: what is left reads well
    for bad in (data[:member], data + gzip.compress(b""), data[:-5]):
        with open(path, "wb") as f:
            f.write(bad)
        with pytest.raises(Exception, match="manifest|short|ended"):
            warc.read_warc(spark, f"{tmp_path}/w").collect()


def test_revisits_name_what_they_refer_to(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/ b", LONG), (2, "http://c", LONG), (2, "http://d", LONG), (3, "x", "y" * 3_000_000)], "page_id bigint, url string, html string")
    manifest = warc.write_warc(pages, f"{tmp_path}/w")
    found = [h for f in manifest["files"] for h, _ in warc.records(open(f"{tmp_path}/w/{f['file']}", "rb")) if h["WARC-Type"] == "revisit"]
    assert [(h["Page-ID"], h["WARC-Refers-To-Target-URI"], h["WARC-Target-URI"]) for h in found] == [("1", "http://d", "http://a/%20b")]
    assert {r.payload_bytes for r in warc.read_warc(spark, f"{tmp_path}/w").collect()} == {2000, 3_000_000}
