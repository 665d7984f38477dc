import base64
import gzip
import hashlib

import pyarrow.fs as pafs
from helpers import rows
from pyspark.sql import functions as F

from tremora.llm import warc
from tremora.llm.common import scratch

PAGES = "page_id long, url string, html string"


def plain(data):
    first = {}
    for i, _, html in data:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in data:
        raw = (html or "").encode()
        f = first.get(html or "")
        response = i == f
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit", None if response else f))
    return sorted(out, key=repr)


def trip(spark, data, chunk=warc.CHUNK):
    out = warc.round_trip(spark, spark.createDataFrame(data, PAGES), chunk)
    return rows(out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


DATA = [
    (3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, "same"), (4, "http://c/\r\nX: y", "é漢字\r\n\r\nWARC/1.1\r\n" * 50), (5, "http://d/", None), (6, "http://e/", ""),
    (7, "http://f/", "x" * 300_000), (8, "http://g/", "y" * 262_144), (9, "http://h/", "z" * 262_145), (10, "http://i/", "x" * 300_000), (11, "", "WARC/1.1"), (12, "http://j/", "\r\n\r\n"),
]


def test_round_trip(spark):
    assert trip(spark, DATA) == plain(DATA)


def test_small_chunks(spark):
    """A record of many chunks, cut within characters, is the same record."""
    assert trip(spark, DATA[3:6], 7) == plain(DATA[3:6])


def test_repeated_rows_and_empty(spark):
    assert trip(spark, []) == []
    twice = [(1, "u", "a"), (1, "u", "a"), (2, "u", "a")]
    assert trip(spark, twice) == plain(twice)


def test_archives_are_warc(spark):
    """Every record is a gzip member of its own, with the fields of the format and a block of its length."""
    pages = spark.createDataFrame(DATA, PAGES)
    manifest = warc.write_archives(warc.chunk_rows(pages, warc.record_rows(pages)), scratch(spark, "warc-test")).collect()
    assert sum(m.records for m in manifest) == len(DATA)
    kinds = []
    for m in manifest:
        fs, path = pafs.FileSystem.from_uri(m.path)
        with fs.open_input_stream(path, compression=None) as f:
            text = gzip.decompress(f.read())
        while text:
            head, _, rest = text.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= fields.keys()
            n = int(fields["Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            if fields["WARC-Type"] == "revisit":
                assert n == 0 and "WARC-Refers-To" in fields
            kinds.append(fields["WARC-Type"])
            text = rest[n + 4 :]
    assert sorted(kinds) == ["response"] * 8 + ["revisit"] * 4


def test_null_ids_and_other_columns(spark):
    data = [(None, "u", "a"), (None, None, "a"), (None, "u", "b"), (None, "u", "b"), (1, "u", "a"), (2, "u", None), (2, "u", "c")]
    assert trip(spark, data) == plain(data)
    df = spark.createDataFrame(data, PAGES)
    for name in ("payload", "sha", "row", "first_id", "chunk_no", "data", "n_bytes"):
        df = df.withColumn(name, F.lit("x"))
    out = warc.round_trip(spark, df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(out) == plain(data)


def test_one_payload_in_most_pages(spark):
    data = [(i, None, "p" * 5000 if i % 10 else f"own {i}") for i in range(500)]
    assert trip(spark, data, 1000) == plain(data)


def test_no_row_that_is_dealt_out_holds_a_payload(spark):
    """Every exchange of the chunked table's plan carries chunks or digests."""
    pages = spark.createDataFrame(DATA, PAGES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warc.chunk_rows(pages, warc.record_rows(pages))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = plan.split("Exchange ")[1:]
    assert exchanges and not any("payload" in line.split("\n")[0] or "html" in line.split("\n")[0] for line in exchanges)
    for part in exchanges:  # what the exchange reads, projected just below it
        below = part.split("\n")[1]
        assert "payload#" not in below.split("[", 1)[-1].split("]")[0] or "substring(payload" in below


def test_archives_of_lost_tasks_go(spark):
    """What the manifest doesn't name is deleted; what it names stays where a folder is given."""
    from pathlib import Path

    at = scratch(spark, "warc-kept")
    folder = Path(at.removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "_left.tmp").write_bytes(b"x")
    (folder / "left.warc.gz").write_bytes(b"x")
    out = warc.round_trip(spark, spark.createDataFrame(DATA, PAGES), folder=at)
    kept = {p.name for p in folder.glob("*.warc.gz")}
    assert kept == {r.archive.rsplit("/", 1)[1] for r in out.collect()} and not (folder / "_left.tmp").exists()
