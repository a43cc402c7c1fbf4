import base64
import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ratingflow.llm import queries, warc
from ratingflow.session import scratch_path
from tests.llm.helpers import SF

SCHEMA = ("page_id long, url string, html string, key string, n long, sha string, lead int, refers_to long, value binary, "
          "archive string, copies int")


def pages(spark, rows, parts=3):
    """(page_id, url, html) rows with columns that clash with the operator's."""
    full = [(*r, "k", 1, "s", None, 5, b"v", "a", 2) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)


def round_trip(spark, rows, **options):
    path = scratch_path(spark, "test-archives")
    warc.write(pages(spark, rows), path, **options)
    found = warc.read(spark, path)
    assert warc.gaps(found).count() == 0
    return [r.asDict() | {"page": r.page} for r in
            warc.records(found).withColumn("page", warc.page_of(F.col("record_id")))
            .withColumn("of", warc.page_of(F.col("refers_to"))).collect()]


ROWS = [(1, "http://a/", "one"), (2, None, "one"), (3, "http://b/ c\r\nX: y", "one"), (4, "u", None), (5, "u", ""),
        (6, "http://c/", "é中" * 300_000), (7, "http://d/", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"),
        (8, "", "z" * 40), (-3, "x", "z" * 40)]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("archive_bytes", [1000, 32 << 20])
def test_pages_come_back(spark, compress, archive_bytes):
    got = {r["page"]: r for r in round_trip(spark, ROWS, compress=compress, archive_bytes=archive_bytes)}
    assert sorted(got) == sorted(r[0] for r in ROWS)
    for page, _, html in ROWS:
        payload = (html or "").encode()
        lead = max(p for p, _, h in ROWS if (h or "") == (html or ""))
        r = got[page]
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r["record_type"], r["of"]) == (("response", None) if page == lead else ("revisit", lead))
        assert r["payload"] == (payload if page == lead else None)
    assert got[3]["uri"] == "http://b/%20c%0D%0AX:%20y" and got[2]["uri"] is None


def test_small_payloads_are_responses(spark):
    got = {r["page"]: r["record_type"] for r in round_trip(spark, ROWS, min_bytes=4)}
    assert [got[p] for p in (1, 2, 3, 4, 5, 8, -3)] == ["response"] * 6 + ["revisit"]


def test_repeated_and_null_ids(spark):
    rows = [(None, "a", "p"), (None, "b", "q"), (9, "c", "p"), (9, "d", "p"), (9, "d", "p"), (2, "e", "q")]
    got = round_trip(spark, rows)
    assert len({r["record_id"] for r in got}) == 6
    kinds = sorted((str(r["page"]), r["record_type"], str(r["of"])) for r in got)
    assert kinds == [("2", "response", "None"), ("9", "response", "None"), ("9", "revisit", "9"), ("9", "revisit", "9"),
                     ("None", "revisit", "2"), ("None", "revisit", "9")]


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_query_equals_plain_grouping(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    largest = {}
    for r in rows:
        largest[r.html or ""] = max(r.page_id, largest.get(r.html or "", r.page_id))
    want = []
    for r in rows:
        payload, lead = (r.html or "").encode(), largest[r.html or ""]
        want.append((r.page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                     *(("response", None) if lead == r.page_id else ("revisit", lead))))
    assert sorted(map(tuple, queries.op11_warc(spark, SF).collect())) == sorted(want)


def archive(n, compress, rng):
    """n records' bytes."""
    out = []
    for i in range(n):
        payload = bytes(rng.choice(b"ab <>\r\n\x1f\x8b\x08\0") for _ in range(rng.randrange(0, 400)))
        data = warc.page_record(str(i), f"http://h/{i}", payload, None, "2020-01-01T00:00:00Z")
        out.append(warc.member(data) if compress else data)
    return out


@pytest.mark.parametrize("compress", [True, False])
def test_every_undamaged_record_is_recovered(compress):
    rng = random.Random(5)
    for _ in range(60):
        parts = archive(12, compress, rng)
        hurt = set(rng.sample(range(12), rng.randrange(0, 5)))
        whole = list(parts)
        for i in hurt:
            p = bytearray(parts[i])
            how = rng.randrange(4)
            if how == 0:                       # a flipped byte
                p[rng.randrange(len(p))] ^= 1 << rng.randrange(8)
            elif how == 1:                     # cut short
                p = p[:rng.randrange(1, len(p) - 5)]
            elif how == 2:                     # overwritten
                at = rng.randrange(len(p))
                p[at:at + 30] = bytes(rng.randrange(256) for _ in range(len(p[at:at + 30])))
            else:                              # gone but for its last bytes
                p = p[-9:]
            whole[i] = bytes(p)
        data = b"".join(whole)
        begin = [sum(map(len, whole[:i])) for i in range(13)]
        found = list(warc.salvage(data))
        ids = {r.record_id for r in found if isinstance(r, warc.Record)}
        assert ids >= {f"urn:page:{i}" for i in range(12) if i not in hurt}
        gaps = [g for g in found if not isinstance(g, warc.Record)]
        # gaps and records make up the archive, and only damaged bytes are left out
        spans = sorted([g[:2] for g in gaps] + [(r.start, r.stop) for r in found if isinstance(r, warc.Record)])
        at = 0
        for a, b in spans:
            assert not data[at:a].strip(b"\0") and a < b
            at = b
        assert not data[at:].strip(b"\0")
        for a, b, reason in gaps:
            assert reason
            inside = [i for i in range(12) if begin[i] < b and a < begin[i + 1]]
            assert set(inside) <= hurt


def test_reasons():
    good = warc.page_record("1", "u", b"payload", None, "d")
    size = int(good.split(b"Content-Length: ")[1].split(b"\r")[0])
    for bad, reason in [(b"junk" + good, "no version line"), (good[:-30], "cut short"),
                        (good.replace(b"payload", b"peyload"), "block digest differs"),
                        (good.replace(b"Content-Length: ", b"Content-Length: x"), "no content length"),
                        (good.replace(b"Length: %d" % size, b"Length: %d" % (size - 1)), "no record end"),
                        (warc.member(good)[:-12], "gzip member cut short"),
                        (warc.member(good)[:-8] + b"12345678", "gzip member")]:
        first = next(iter(warc.salvage(bad)))
        assert not isinstance(first, warc.Record) and first[2].startswith(reason), (bad, first)


def test_foreign_archives():
    """Other record kinds, folded headers, several records a member, padding."""
    info = warc.record("warcinfo", "urn:uuid:1", b"software: x\r\n", "d", {"X": "a\r\n b"})
    page = warc.page_record("1", None, b"", None, "d")
    data = gzip.compress(info + page) + b"\0\0\0" + warc.member(page)
    found = list(warc.salvage(data))
    assert [r.kind for r in found] == ["warcinfo", "response", "response"]
    assert found[0].payload == b"software: x\r\n" and found[0].fields["x"] == "a b"
    assert list(warc.salvage(b"")) == []


def test_damaged_archives_through_spark(spark):
    rows = [(i, "http://u", f"page {i} " * 50) for i in range(40)]
    path = scratch_path(spark, "test-archives")
    warc.write(pages(spark, rows, 2), path, archive_bytes=1 << 20)
    files = [(r.path, bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    broken = scratch_path(spark, "test-archives").removeprefix("file:")
    import os
    os.makedirs(broken)
    lost = 0
    for n, (_, data) in enumerate(files):
        starts = [r.start for r in warc.salvage(data)]
        hole = bytearray(data)
        hole[starts[3] + 20] ^= 0xFF
        lost += 1
        with open(f"{broken}/{n}.warc.gz", "wb") as f:
            f.write(hole)
    found = warc.read(spark, broken)
    assert warc.records(found).count() == 40 - lost
    gaps = warc.gaps(found).collect()
    assert len(gaps) == lost and all("gzip member" in g.reason and g.archive.endswith(".warc.gz") for g in gaps)


def test_records_beyond_16_mib_keep_their_last_byte(spark):
    data = warc.member(b"x" * (1 << 24))
    assert data[-1] == 1 and zlib.decompressobj(31).decompress(data)[:1] == b"x"
    rows = [(1, "u", "y" * (17 << 20)), (2, "u", "small")]
    got = {r["page"]: r["payload_bytes"] for r in round_trip(spark, rows)}
    assert got == {1: 17 << 20, 2: 5}
