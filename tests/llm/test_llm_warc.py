import hashlib
import random

import pytest

from sluice.llm.warc import LoserTree, archive, merge_index, parse, read_index, sound, surt

PAGES = "page_id long, url string, html string"
BIG = "<html>" + "same " * 300
ROWS = [
    (1, "http://www.b.example/x?q=1#f", BIG),
    (2, "https://a.example/é path\r\nInjected: yes", BIG),
    (3, None, "small"),
    (4, "http://a.example/", "small"),
    (5, "http://a.example/", None),
    (6, "http://a.example/", ""),
    (7, "http://a.example/z", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "é" * 700),
    (8, "not a url [", BIG),
    (9, "http://a.example/", BIG + "!"),
    (None, "http://a.example/none", "null id"),
    (3, None, "small"),
]


def want(rows):
    top = {}
    for p, _, h in rows:
        if len((h or "").encode()) >= 1000:
            top[h] = max(p, top.get(h, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        last = top.get(h, p)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if last != p else "response", last if last != p else None))
    return out


def key(rows):
    return sorted(map(str, rows))


def test_round_trip_of_odd_pages(spark, scratch):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(ROWS, PAGES).withColumns({c: F.lit("clash") for c in ("payload", "digest", "file", "range")})
    got = archive(pages, f"{scratch}/odd").orderBy("range", "place").collect()
    assert key((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == key(want(ROWS))
    assert all(r["whole"] for r in got)
    order = [(r["urlkey"], r["captured"], r["record"]) for r in got]
    assert order == sorted(order)
    assert sum(r["url"] is None for r in got) == 2


def test_archives_hold_whole_records(spark, scratch):
    import glob

    archive(spark.createDataFrame(ROWS, PAGES), f"{scratch}/files")
    records = []
    for f in glob.glob(f"{scratch}/files/part-*"):
        data = open(f, "rb").read()
        records += [(data[at:at + n], fields, bytes(block)) for at, n, fields, block in parse(data)]
    assert len(records) == len(ROWS)
    for raw, fields, block in records:
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and len(block) == int(fields["content-length"])
        assert "injected" not in fields
        if fields["warc-type"] == "response":
            assert hashlib.sha1(block.partition(b"\r\n\r\n")[2]).hexdigest() == fields["warc-payload-digest"][5:]


def test_empty_table(spark, scratch):
    assert archive(spark.createDataFrame([], PAGES), f"{scratch}/none").collect() == []


def test_many_ranges_keep_the_order(spark, scratch):
    rows = [(i, f"http://h{i % 7}.example/{i % 3}", "x" * (i % 50)) for i in range(500)]
    archive(spark.createDataFrame(rows, PAGES).repartition(6), f"{scratch}/many")
    got = merge_index(read_index(spark, f"{scratch}/many"), per_range=60).orderBy("range", "place").collect()
    order = [(r["urlkey"], r["captured"]) for r in got]
    assert order == sorted(order) and len(got) == 500 and len({r["range"] for r in got}) > 3


@pytest.mark.parametrize("k", [0, 1, 2, 3, 8, 13])
def test_loser_tree_merges(k):
    r = random.Random(k)
    runs = [sorted(r.randint(0, 30) for _ in range(r.randint(0, 20))) for _ in range(k)]
    assert list(LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_surt_orders_hosts():
    assert surt("http://www.a.example:80/p?q#f") == "example,a)/p?q"
    assert surt(None) == surt("") == ""


def test_a_damaged_record_stops_the_job(spark, scratch):
    import glob

    path = f"{scratch}/damaged"
    archive(spark.createDataFrame([(1, "http://a.example/", "sound payload")], PAGES), path)
    assert sound(read_index(spark, path)).count() == 1
    import os

    name, = (f for f in glob.glob(f"{path}/part-*") if os.path.getsize(f))
    raw = open(name, "rb").read()
    for crc in glob.glob(f"{path}/.*.crc"):
        os.remove(crc)
    open(name, "wb").write(raw.replace(b"sound payload", b"sOund payload"))
    with pytest.raises(Exception, match="damaged record"):
        sound(read_index(spark, path)).collect()
