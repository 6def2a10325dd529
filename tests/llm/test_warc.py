import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from plumbline.llm import warc as W

PAGES = "page_id bigint, url string, html string"
LONG = "<p>" + "é page " * 60


def fixture(spark):
    rows = [(5, "http://a/5", LONG), (2, "http://a/2", LONG), (9, None, LONG), (1, "http://a/1", "short"), (3, "http://a/3", "short"), (4, "u\r\nX: y", None),
            (6, "http://a/6", ""), (None, "http://a/n", LONG), (7, "http://a/7", "x" * 100), (8, "http://a/8", "x" * 100), (10, "http://a/10", "x" * 99),
            (11, "http://a/11", "x" * 99), (2, "http://a/2", LONG)] + [(100 + i, f"http://b/{i}", f"<b>{i}</b>" * 50) for i in range(30)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES + ", payload string, path string"), rows


def test_round_trip(spark):
    pages, rows = fixture(spark)
    got = W.round_trip(pages.repartition(3)).collect()
    assert sorted((str(r["page_id"]), r["target_uri"]) for r in got) == sorted((str(i), None if u is None else u.replace("\r\n", "")) for i, u, _ in rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        data = html[r["page_id"]]
        again = r["page_id"] in (5, 9, None) or r["page_id"] == 8
        assert r["record_type"] == ("revisit" if again else "response")
        assert r["refers_to"] == ((7 if r["page_id"] == 8 else 2) if again else None)
        assert (r["payload"] is None) if again else bytes(r["payload"]) == data
        assert r["payload_digest"] == hashlib.sha256(data).hexdigest() and r["payload_length"] == len(data)


def test_archive_layout(spark, tmp_path):
    pages, rows = fixture(spark)
    dictionary = W.trained_dictionary(pages)
    assert dictionary
    manifest = W.write_archives(W.typed_records(pages).coalesce(1), str(tmp_path / "w"), dictionary, archive_bytes=40_000).collect()
    assert len(manifest) >= 1 and sum(r["n_records"] for r in manifest) == len(rows)
    with open(manifest[0]["path"], "rb") as f:
        head = f.read(8)
        assert struct.unpack("<II", head)[0] == W.SKIPPABLE_DICTIONARY
        found = list(W.frames(io.BytesIO(head + f.read())))
    assert [m for m, _ in found] == [W.SKIPPABLE_DICTIONARY] + [W.FRAME] * manifest[0]["n_records"]
    own = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(found[0][1]))
    record = zstandard.ZstdDecompressor(dict_data=own).decompress(found[1][1])
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def archive(path, *records, dictionary=b"", tail=b""):
    writer = W.ArchiveWriter(str(path.parent), dictionary)
    for r in records:
        writer.add(r)
    writer.close()
    with open(writer.path, "ab") as f:
        f.write(tail)
    return writer.path


def good(i=1, data=b"body"):
    return W.record_bytes(f"<urn:plumbline:page:{i}>", "response", "http://x", "2024-01-01T00:00:00Z", data, hashlib.sha256(data).hexdigest(), len(data), None)


@pytest.mark.parametrize("bad,why", [
    (good().replace(b"WARC/1.1", b"WARC/9.9"), "version"), (good().replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""), "without"),
    (good()[:-1], "block"), (good() + good(2), "block"), (good().replace(b"body", b"b0dy"), "digest"), (b"junk", "end of headers"),
    (good().replace(b"WARC-Type: response", b"WARC-Type response"), "header line"),
    (good().replace(b"Content-Length: 4", b"Content-Length: 5"), "declared")])
def test_faults(tmp_path, bad, why):
    path = archive(tmp_path / "a", good(1), bad, good(3))
    with pytest.raises(W.WarcError, match=why):
        list(W.archive_rows(path))
    rows = list(W.archive_rows(path, "report"))
    assert [r[0] and r[0][-2] for r in rows] == ["1", None, "3"] and why in rows[1][-1]


def test_cut_and_foreign_archives(tmp_path):
    whole = archive(tmp_path / "a", good(1), good(2, b"x" * 5000))
    data = open(whole, "rb").read()
    for cut in (len(data) - 3, len(data) - 5000 if len(data) > 5100 else len(data) - 20):
        (tmp_path / "cut").write_bytes(data[:cut])
        rows = list(W.archive_rows(str(tmp_path / "cut"), "report"))
        assert rows[0][-1] is None and rows[-1][-1]
    (tmp_path / "none").write_bytes(b"no archive at all")
    assert "unknown frame" in list(W.archive_rows(str(tmp_path / "none"), "report"))[0][-1]
    (tmp_path / "empty").write_bytes(b"")
    assert list(W.archive_rows(str(tmp_path / "empty"))) == []
    # An uncompressed dictionary, another skippable frame, and a frame without a content size.
    plain = zstandard.train_dictionary(2000, [good(i, bytes([65 + i % 20]) * 50 + str(i).encode() * 9) for i in range(200)])
    out = struct.pack("<II", W.SKIPPABLE_DICTIONARY, len(plain.as_bytes())) + plain.as_bytes() + struct.pack("<II", 0x184D2A50, 3) + b"abc"
    out += zstandard.ZstdCompressor(dict_data=plain, write_content_size=False).compress(good(7))
    (tmp_path / "plain").write_bytes(out)
    assert [r[0] for r in W.archive_rows(str(tmp_path / "plain"))] == ["<urn:plumbline:page:7>"]


def test_large_record_and_small_reads(tmp_path, monkeypatch):
    monkeypatch.setattr(W, "READ_BYTES", 7)
    import os
    path = archive(tmp_path / "a", good(1), good(2, os.urandom(300_000)), good(3, b""))
    assert [r[5] for r in W.archive_rows(path)] == [4, 300_000, 0]


def test_empty(spark):
    pages, _ = fixture(spark)
    assert W.round_trip(pages.limit(0)).count() == 0
    few = W.round_trip(pages.where("page_id = 1").select("page_id", "url", F.lit(None).cast("string").alias("html"))).collect()
    assert [(r["page_id"], bytes(r["payload"]), r["record_type"]) for r in few] == [(1, b"", "response")]


def test_hot_payloads_are_looked_up_apart(spark, monkeypatch):
    pages, _ = fixture(spark)
    monkeypatch.setitem(W.__dict__, "MOST_HOT", 1)

    def typed(hot):
        rows = W.typed_records(pages, hot=hot).select("page_id", "payload_digest", "record_type", "refers_to").collect()
        return sorted(map(str, rows))

    want = typed(10**9)         # none is hot
    assert sum("revisit" in r for r in want) == 4
    assert typed(1) == typed(2) == want     # 1: two payloads are, one more than the list may hold, so that the bound is raised
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert typed(2) == want
        assert W.typed_records(pages.limit(0), hot=1).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
