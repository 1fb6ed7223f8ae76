"""WARC archives: round trips, dictionaries, deduplication, and what breaks the format."""

import base64
import hashlib
import random
import struct

import pytest

from lexspark.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, b"x", "n") for r in rows], "page_id long, url string, html string, content binary, name string")


def test_round_trip(spark):
    r = random.Random(5)
    texts = [None, "", "é🙂", "\r\n\r\n", "WARC/1.1\r\n\r\n", "x" * 300_000] + ["<p>" + "word " * r.randint(1, 99) + "</p>" for _ in range(200)]
    rows = [(k, None if k % 7 == 0 else f"http://a.b/ü {k}\r\n%0A", r.choice(texts)) for k in range(400)] + [(1000 + k, "u", t) for k, t in enumerate(texts)]
    for least in (0, 50):
        got = {x["page_id"]: x for x in warc.round_trip(pages(spark, rows), min_bytes=least, archive=1 << 16).collect()}
        first = {}
        for k, _, t in rows:
            first[t or ""] = max(k, first.get(t or "", k))
        assert len(got) == len(rows)
        for k, url, t in rows:
            data = (t or "").encode()
            x, to = got[k], first[t or ""] if len(data) >= least and first[t or ""] != k else None
            assert (x["payload_bytes"], x["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
            assert (x["record_type"], x["refers_to"], x["url"]) == ("revisit" if to is not None else "response", to, url)
            assert x["payload"] == (None if to is not None else data)


def test_archives_as_files(spark, tmp_path):
    rows = [(k, "u", f"<p>page {k} " + "of some text " * 20) for k in range(300)]
    archives = warc.write_archives(pages(spark, rows), archive=1 << 15).collect()
    assert len(archives) > 3 and len({a["name"] for a in archives}) == len(archives)
    assert any(struct.unpack_from("<I", a["content"])[0] == warc.DICTIONARY_MAGIC for a in archives)
    for a in archives:
        (tmp_path / a["name"]).write_bytes(a["content"])
    got = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path)), "path").collect()
    assert {x["page_id"]: x["payload"].decode() for x in got} == {k: t for k, _, t in rows}


def test_odd_rows(spark):
    rows = [(None, None, "same"), (None, "u", "same"), (3, "u", "same"), (3, "u", "same"), (4, "u", None)]
    got = sorted((x["page_id"] or 0, x["record_type"], x["refers_to"]) for x in warc.round_trip(pages(spark, rows)).collect())
    assert got == [(0, "revisit", 3), (0, "revisit", 3), (3, "response", None), (3, "response", None), (4, "response", None)]
    assert warc.round_trip(pages(spark, rows).limit(0)).count() == 0


def records(n=20):
    return [warc.record(k, "u", f"payload {k} ".encode() * 30, None, False) for k in range(n)]


@pytest.mark.parametrize("level", [1, 3, 19])
def test_frames(level):
    for n in (0, 1, 7, 20, 64):
        assert list(warc.frames(warc.pack(records(n), level))) == records(n)


def test_broken_archives(spark):
    whole = warc.pack(records())
    head = 8 + struct.unpack_from("<I", whole, 4)[0]
    r = random.Random(1)
    for cut in [*(r.randrange(head + 1, len(whole) - 1) for _ in range(40)), 9]:
        if cut in {head + sum(warc.frame_size(memoryview(whole), head) for _ in range(1))}:
            continue
        with pytest.raises(warc.BadArchive):
            out = [warc.parse(x) for x in warc.frames(whole[:cut])]
            assert len(out) < 20
            raise warc.BadArchive("cut between frames")
    good = records(1)[0]
    for bad in (good[:-1], good + b"x", good.replace(b"payload 0", b"payload 1", 1), good.replace(b"WARC-Date", b"WARC-Dato"), good.replace(b"WARC/1.1", b"WARC/9"), b"", good.replace(b"Content-Length: ", b"Content-Length: 9", 1)):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)
    table = spark.createDataFrame([("a", bytearray(whole[:-5])), ("b", None), ("c", bytearray(whole))], "name string, content binary")
    assert warc.read_archives(table, strict=False).groupBy("archive").count().orderBy("archive").collect() == [("a", 19), ("c", 20)]
    with pytest.raises(Exception, match="cut off"):
        warc.read_archives(table).collect()
