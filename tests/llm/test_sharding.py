import zlib

import pytest

from metroloom.llm import sharding

from .conftest import docs


@pytest.mark.parametrize(("shards", "slack"), [(24, 0.01), (3, 0.5), (200, 0.01), (1, 0.01)])
def test_sizes_slots_and_groups(spark, odd_texts, shards, slack):
    texts = [t for t in odd_texts if len(t or "") < 10_000] * 4
    df = docs(spark, texts)
    df = df.union(df.filter("doc_id = 3"))
    got = sharding.shard_by_bytes(df, shards=shards, slack=slack).collect()
    assert len(got) == len(texts) + 1
    of = {}
    for r in got:
        t = texts[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 8 and r["text_crc32"] == zlib.crc32(t.encode())
        of.setdefault(r["shard"], []).append(r)
    for rows in of.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    total = sum(r["size"] for r in got)
    most = max(r["size"] for r in got)
    assert set(of) <= set(range(shards))
    for s in range(shards):
        assert abs(sum(r["size"] for r in of.get(s, [])) - total / shards) <= most + slack * 2 * total / shards
    groups = {}
    for r in got:
        groups.setdefault(texts[r["doc_id"]] or "", []).append(r)
    for rows in groups.values():
        if sum(r["size"] for r in rows) <= total * slack / shards:
            assert len({r["shard"] for r in rows}) == 1


def test_empty(spark):
    assert sharding.shard_by_bytes(docs(spark, ["a"]).limit(0)).count() == 0
