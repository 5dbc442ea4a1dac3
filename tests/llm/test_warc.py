"""Archives: exact round trip, index look-ups, revisits."""

import gzip
import hashlib

from pyspark.sql import functions as F

from kerbside.llm import warc
from kerbside.llm.common import scratch
from llm_tables import CLASH

BIG = "<p>same payload ü</p>" * 20


def rows_of():
    rows = [(i, f"https://www.h{i % 7}.example.com/p/{i}?q=a b", f"<html>page {i} é</html>" * (i % 9 + 1)) for i in range(300)]
    rows += [(500, "http://x.example.com/", BIG), (400, "http://y.example.com/a", BIG), (450, None, BIG),
             (401, "http://x.example.com/", "short"), (402, "http://x.example.com/", "short"), (403, "http://z.example.com:80/\r\n", None),
             (404, "not a url", ""), (405, "http://[bad/", "x" * 100_000), (400, "http://y.example.com/a", BIG),
             (None, "http://n.example.com/", BIG), (7, "https://www.h0.example.com/p/7?q=a b", "again")]
    return rows


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in CLASH + ["digest", "first", "last", "surt"] if clash else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def wanted(rows):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        response = len(h) < 100 or i is None or first[h] == i
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "response" if response else "revisit", None if response else first[h]))
    return out


def test_round_trip(spark):
    rows = rows_of()
    got = [tuple(r) for r in warc.archive_and_read(frame(spark, rows, clash=True)).collect()]
    assert sorted(got, key=str) == sorted(wanted(rows), key=str)
    assert warc.archive_and_read(frame(spark, [])).collect() == []


def test_index_finds_keys_by_range_reads(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = rows_of()
    root = scratch(spark, "warc-test")
    captures = warc.write_archives(frame(spark, rows), root)
    shards = [(r["first"], r["last"], r["shard"]) for r in warc.write_index(captures, root).collect()]
    reader = warc.Reader(root, shards)
    keys = sorted({(r["surt"], r["page_id"]) for r in captures.collect()}, key=str)
    pages = {}
    for i, u, h in rows:
        pages.setdefault((warc.surt(u), None if i is None else str(i)), []).append(h or "")
    assert len(keys) == len(pages)
    for s, i in keys:
        key = f"{s} {(i or '').rjust(20)}"
        found = [reader.read(*x[1:]) for x in reader.find(key)]
        assert len(found) == len(pages[s, i])
        for r in found:
            assert r["warc-type"] == "revisit" or r["payload"].decode() in pages[s, i]
    assert list(reader.find("zzz")) == [] and list(reader.find("")) == []
    back = warc.lookup(spark, root, spark.createDataFrame(shards, "first string, last string, shard string"),
                       spark.createDataFrame([keys[3], ("com,example)/none", "1")], "surt string, page_id string"), payload=True)
    assert back.count() == len(pages[keys[3]])


def test_keys_and_records():
    assert warc.surt("http://www.News.example.com:8080/a b?x=1#f") == "com,example,news:8080)/a%20b?x=1"
    assert warc.surt("https://example.org") == "org,example)/" and warc.surt(None) == ""
    member = warc.record("5", "http://a/\r\nEvil: 1", b"data", "00", None)
    fields = warc.parse(member)
    assert fields["payload"] == b"data" and "evil" not in fields and fields["warc-target-uri"] == "http://a/%0D%0AEvil: 1"
    assert gzip.decompress(member).endswith(b"data\r\n\r\n")
