import hashlib
import random

import pyarrow.fs as fs

from metroloom.llm import warc


def test_keys():
    assert warc.surt("HTTP://user@www.Blog.Example.com:80/a?b#c") == "com,example,blog)/a?b"
    assert warc.surt("https://x.org:8443") == "org,x:8443)/" and warc.surt(None) == "" and warc.surt("x.org?q") == "org,x)/?q"


def test_archive_round_trip(spark):
    rng = random.Random(4)
    big = "é<p>" * 500
    html = [None, "", "small", "small", big, big, big, *("".join(rng.choice("abc\r\n é") for _ in range(rng.randint(0, 4000))) for _ in range(300)), "y" * 3_000_000]
    rows = [(i, f"http://h{i % 7}.example.com/{i % 50}\r\nX: y" if i != 9 else None, h) for i, h in enumerate(html)]
    rows += [(6, "http://again.org/", big), (None, "http://null.org/", "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'q' AS page", "'w' AS same", "'e' AS key").repartition(5)
    archive = warc.write_archive(df, warc.new_root(spark))
    index = warc.lookup(archive, warc.keys_of(df))
    records = warc.read_records(archive, index).collect()
    assert len(records) == len(rows) == index.count()
    winner = {}
    for p, _, h in rows:
        if len((h or "").encode()) >= 1000 and p is not None:
            winner[h] = max(p, winner.get(h, p))
    want = []
    for p, _, h in rows:
        body = (h or "").encode()
        ref = winner[h] if p is not None and h in winner and winner[h] != p else None
        want.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if ref is not None else "response", ref))
    key = lambda x: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in x)
    assert sorted(((r["page"], r["payload_bytes"], r["payload_sha1"], r["type"], r["refers_to"]) for r in records), key=key) == sorted(want, key=key)
    one = warc.lookup(archive, spark.createDataFrame([("com,example,h3)/3",), ("org,none)/",), ("",)], "key string")).collect()
    assert {r["key"] for r in one} <= {"com,example,h3)/3", ""}
    assert all(bytes(r["payload"]) == (rows[r["page"]][2] or "").encode() for r in records if r["type"] == "response" and r["page"] not in (None, 6))
    files, base = fs.FileSystem.from_uri(archive.root)
    assert not [f.path for f in files.get_file_info(fs.FileSelector(base)) if not f.path.endswith((".warc.gz", ".blocks", ".directory"))]


def test_index_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [(f"k{i % 40:03d}", "v", i, 1) for i in range(1000)] + [("k020", "v", 5000 + i, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, volume string, offset bigint, length bigint").repartition(6)
    archive = warc.build_index(df, warc.new_root(spark))
    index = warc.Index(archive)
    for k in range(40):
        assert sorted(o for _, o, _ in index.find(f"k{k:03d}")) == sorted(r[2] for r in rows if r[0] == f"k{k:03d}")
    assert list(index.find("k0")) == [] and list(index.find("zzz")) == []


def test_empty_archive(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    archive = warc.write_archive(df, warc.new_root(spark))
    assert warc.read_records(archive, warc.lookup(archive, warc.keys_of(df))).count() == 0


def test_signs_that_are_encoded_keep_their_rows(spark, monkeypatch):
    """Encoding changes the order of keys and joins some of them; each page comes back once."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    paths = ["b c", "b!c", "z", "é", "a b", "a%20b", "a\tb", "日本", "~", "%", "ü z", "A", "é/日"]
    rows = [(i, f"http://{h}.org/{p}", f"page {i}") for i, (h, p) in enumerate((h, p) for h in ("a", "bücher", "z") for p in paths)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    archive = warc.write_archive(df, warc.new_root(spark))
    records = warc.read_records(archive, warc.lookup(archive, warc.keys_of(df))).collect()
    assert sorted((r["page"], bytes(r["payload"]).decode()) for r in records) == [(i, h) for i, _, h in rows]
    index = warc.Index(archive)
    for _, u, _ in rows:
        assert len(list(index.find(warc.surt(u)))) == sum(warc.clean(warc.surt(v)) == warc.clean(warc.surt(u)) for _, v, _ in rows)
