"""The content-addressed archive: round trip of records, odd rows, altered payloads."""

import base64
import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from stockroute.llm import warc

PAGES = [(5, "http://a.org/1", "same"), (3, "http://a.org/2", "same"), (9, "http://a.org/3", "same"),
         (1, "http://b.org/?x=1\r\nWARC-Type: revisit", "<p>Größe</p>\r\n\r\nWARC/1.1"), (2, None, None), (4, "x", ""),
         (None, "http://n.org", "same"), (None, "http://n.org/2", "alone"), (7, "u", "twice"), (7, "u", "twice"),
         (8, "v", "long " * 40_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "k", 1, b"z") for p in PAGES],
                                 "page_id long, url string, html string, key string, first_id int, payload binary")


def _plain(rows, least=0):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [j for j, _, other in rows if (other or "") == (html or "") and j is not None]
        first = min(ids, default=None)
        again = len(raw) >= least and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def _read(spark, archive):
    found = warc.read_records(spark, archive).select(
        "page_id", F.octet_length("payload"), "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_records_read_back(spark, pages, tmp_path, least):
    archive = warc.write_archive(pages, str(tmp_path / "a"), least_bytes=least)
    assert _read(spark, archive) == _plain(PAGES, least)
    # each payload is stored once
    assert archive.payloads(spark).count() == len({html or "" for _, _, html in PAGES})


def _parse(folder):
    """Records of plain WARC files: (fields, block), cut by Content-Length alone."""
    out = []
    for name in glob.glob(f"{folder}/part-*"):
        data, at = open(name, "rb").read(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            version, *lines = data[at:end].decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            size = int(fields["Content-Length"])
            block, at = data[end + 4:end + 4 + size], end + 4 + size
            assert version == "WARC/1.1" and data[at:at + 4] == b"\r\n\r\n"
            out.append((fields, block))
            at += 4
    return out


def test_warc_files(spark, pages, tmp_path):
    archive = warc.write_archive(pages, str(tmp_path / "a"))
    records = warc.read_records(spark, archive)
    warc.write_warc(records, str(tmp_path / "short"))
    warc.write_warc(records, str(tmp_path / "whole"), whole=True)
    short, whole = _parse(tmp_path / "short"), _parse(tmp_path / "whole")
    assert sum(len(b) for _, b in short) < sum(len(b) for _, b in whole)
    assert sorted(b for _, b in whole) == sorted((html or "").encode() for _, _, html in PAGES)
    assert {f["WARC-Type"] for f, _ in whole} == {"response"}
    for f, b in whole:
        assert f["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert sum(f["WARC-Type"] == "revisit" for f, _ in short) == 4


def test_altered_and_missing_payloads_are_errors(spark, pages, tmp_path):
    archive = warc.write_archive(pages, str(tmp_path / "a"))
    stored = archive.payloads(spark)
    bad = F.when(F.col("first_id") == 3, F.encode(F.lit("lame"), "utf-8")).otherwise(F.col("payload"))
    stored.withColumn("payload", bad).write.parquet(str(tmp_path / "bad"))
    stored.where("first_id > 3").write.parquet(str(tmp_path / "few"))
    for folder, words in (("bad", "altered payload"), ("few", "no payload for")):
        with pytest.raises(Exception, match=words):
            _read(spark, warc.Archive(str(tmp_path / folder), archive.record_path))


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert _read(spark, warc.write_archive(empty, str(tmp_path / "a"))) == []
