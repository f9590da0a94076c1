import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hangscope.llm import warc
from hangscope.llm.common import open_shared, scratch_dir

BIG = "".join(random.Random(1).choices("abcdefé ", k=3 * warc.CHUNK))


@pytest.fixture(scope="module")
def pages(spark):
    same = "s" * 1000
    rows = [(1, "http://a/ b\r\nX: y", same, "o"), (2, None, same, "o"), (3, "u", same, "o"), (3, "u", same, "o"), (None, "u", same, "o"),
            (4, "u", None, "o"), (5, "u", "", "o"), (6, "u", "t" * 999, "o"), (7, "u", "t" * 999, "o"), (8, "u", BIG, "o"), (9, "u", BIG, "o"),
            (10, "u", "é" * 500, "o"), (11, "u", "é" * 500, "o"), (12, "u", "WARC/1.1\r\n\r\n" * 200, "o"), (None, "u", "n" * 2000, "o"), (None, "v", "n" * 2000, "o")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)


def by_hand(rows):
    body = [(r.html or "").encode() for r in rows]
    best = {}
    for r, b in zip(rows, body):
        if len(b) >= 1000 and r.page_id is not None:
            best[b] = max(best.get(b, r.page_id), r.page_id)
    out = []
    for r, b in zip(rows, body):
        t = best.get(b)
        if sum(x == b for x in body) < 2 or t is None or r.page_id == t:
            t = None
        out.append((r.page_id, len(b), hashlib.sha1(b).hexdigest(), "revisit" if t is not None else "response", t))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    got = warc.archive_round_trip(pages, roll_bytes=3000).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == by_hand(pages.collect())
    assert [r.url for r in got if r.page_id == 1] == ["http://a/%20b%0D%0AX:%20y"]


def test_members_stand_alone_and_equal_the_stream(spark, pages):
    root = scratch_dir(spark, "warc-test")
    listed = warc.write_monolithic(warc.mark_revisits(pages), root)
    index = warc.normalise(listed, root).collect()
    assert len(index) == pages.count()
    for name in {r.archive for r in index}:
        fs, path = open_shared(f"{root}/monolithic/{name}")
        whole = gzip.decompress(fs.open_input_file(path).read())
        fs, path = open_shared(f"{root}/archives/{name}")
        data = fs.open_input_file(path).read()
        members = sorted((r for r in index if r.archive == name), key=lambda r: r.offset)
        assert members[-1].offset + members[-1].length == len(data)
        assert b"".join(gzip.decompress(data[r.offset:r.offset + r.length]) for r in members) == whole


def test_truncated_archive_fails(spark, tmp_path):
    (tmp_path / "monolithic").mkdir()
    rec = warc.record_bytes({"type": "response", "payload": "abc", "n_bytes": 3, "id": 1, "url": "u", "digest": "d", "refers_to": None})
    (tmp_path / "monolithic" / "x").write_bytes(gzip.compress(rec + rec[:-30]))
    with pytest.raises(ValueError):
        warc.normalise_file(f"{tmp_path}/monolithic/x", f"{tmp_path}/a/x", f"{tmp_path}/i/x")


def test_empty(spark, pages):
    assert warc.archive_round_trip(pages.filter("false")).count() == 0
