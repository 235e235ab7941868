import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from metroloom.llm import exact_dedup, near_dup, words

from .conftest import docs
from .test_tokens import alternating


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            n = len(x & y)
            if x and y and 100 * n >= percent * (len(x) + len(y) - n):
                ra, rb = sorted((find(sets[a][0]), find(sets[b][0])))
                up[rb] = ra
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize(("keep", "runs", "fan_in"), [("largest", 64, 8), ("smallest", 5, 2), ("largest", 1, 2)])
def test_exact(spark, odd_texts, keep, runs, fan_in):
    df = docs(spark, odd_texts)
    df = df.union(df.filter("doc_id = 3"))
    got = exact_dedup.exact_duplicates(df, keep=keep, runs=runs, fan_in=fan_in).collect()
    rows = [*enumerate(odd_texts), (3, odd_texts[3])]
    pick = max if keep == "largest" else min
    for r in got:
        t = odd_texts[r["doc_id"]] or ""
        same = [i for i, x in rows if (x or "") == t]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (pick(same), len(same), pick(same) == r["doc_id"], hashlib.sha256(t.encode()).hexdigest())
    assert len(got) == len(rows)
    assert exact_dedup.exact_duplicates(df.limit(0)).count() == 0
    assert exact_dedup.drop_duplicates(df).columns == df.columns


def test_exact_drop_keeps_one_of_each_text(spark):
    left = exact_dedup.drop_duplicates(docs(spark, ["a", "a", "b", None, "", "b"]))
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4, 5]


def test_exact_rounds_merge_sorted_runs(spark):
    """One exchange brings the runs together; each round after it is a sort and a pass over neighbours, without an exchange."""
    entries = spark.createDataFrame([(i % 64, b"d%d" % (i % 9), "c", i, 1) for i in range(500)], "run int, digest binary, check string, doc_id bigint, rows bigint").groupBy("run", "digest", "check").agg({"doc_id": "max", "rows": "sum"})
    entries = entries.select("run", "digest", "check", entries["max(doc_id)"].alias("doc_id"), entries["sum(rows)"].alias("rows"))
    merged = exact_dedup.merge_tree(entries, "doc_id", "largest", 64, 2)
    plan = merged._jdf.queryExecution().executedPlan().toString().split("HashAggregate")[0]
    assert plan.count("Window [") == 6 and plan.count("Exchange") == 1 and plan.count("Sort [") >= 6
    assert sorted((bytes(r["digest"]), r["doc_id"], r["rows"]) for r in merged.collect()) == sorted((b"d%d" % k, max(range(k, 500, 9)), len(range(k, 500, 9))) for k in range(9))


def test_exact_drop_of_an_identifier_with_two_texts(spark):
    df = docs(spark, ["a", "b"]).union(docs(spark, ["b"]))  # 0: a, 1: b, 0: b
    assert sorted((r["doc_id"], r["text"]) for r in exact_dedup.drop_duplicates(df).collect()) == [(0, "a"), (1, "b")]


def family(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = "e%d" % rng.randrange(10**9)
    return " ".join(w)


def test_near_against_brute_force(spark, odd_texts):
    rng = random.Random(8)
    text = lambda n: " ".join("w%d" % rng.randrange(5000) for _ in range(n))
    base, other = text(400), text(200)
    texts = [*odd_texts, base, base.upper(), base.replace(" ", "\n")]
    texts += [family(rng, base, rng.randint(1, 9)) for _ in range(120)]  # a star: members may link to the base alone
    texts += [family(rng, other, e) for e in range(8) for _ in range(3)]
    texts += [text(120) + " " + other for _ in range(6)] + ["one two three four", "One  two three FOUR", "one two three four five"]
    rows = list(enumerate(texts))
    for percent in (85, 80):
        got = near_dup.near_duplicates(docs(spark, texts), percent=percent).collect()
        want = brute_components(rows, percent)
        assert len(got) == len(rows)
        for r in got:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])


def planted(n, edits=10):
    """Texts of one template, unlike each other, each but the last third with a near copy."""
    rng = random.Random(12)
    base = " ".join("w%d" % rng.randrange(9000) for _ in range(300))
    texts = [family(rng, base, edits) for _ in range(n)]
    return texts + [family(rng, t, 5) for t in texts[: n * 2 // 3]]


def test_near_links_of_a_template_in_dense_regions(spark, monkeypatch):
    """Dense regions of every depth: planted pairs that neither neighbours nor pivots need to join are found."""
    texts = planted(600)
    want = brute_components(list(enumerate(texts)), 80)
    assert sum(i != c for i, (_, c) in want.items()) >= 400
    rounds, asked = [], []
    inner_members, inner_blocks = near_dup.members_of, near_dup.blocks_of
    monkeypatch.setattr(near_dup, "members_of", lambda rows, depth, carried: (rounds.append(depth), inner_members(rows, depth, carried))[1])
    monkeypatch.setattr(near_dup, "blocks_of", lambda members, shapes: (asked.append(shapes.filter("direct").count()), inner_blocks(members, shapes))[1])
    monkeypatch.setattr(near_dup, "BLOCK", 64)  # used in plans alone: many rows are beyond a block at the first depths
    got = near_dup.near_duplicates(docs(spark, texts), percent=80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(rounds) >= 2 and sum(asked) > 0


def test_near_star_of_one_text(spark):
    """Copies that link to their common origin alone, in one dense region."""
    rng = random.Random(11)
    base = " ".join("w%d" % rng.randrange(9000) for _ in range(300))
    texts = [base] + [family(rng, base, 3) for _ in range(400)]
    got = near_dup.near_duplicates(docs(spark, texts), percent=80).collect()
    assert {r["component_id"] for r in got} == {0}


def test_neighbours_share_the_longest_prefixes():
    """In one region of more than WINDOW + 1 rows only rows side by side are compared, besides pivots; in a smaller one all are."""
    rng = np.random.default_rng(0)

    def run(n):
        levels = np.sort(rng.integers(0, 4, (n, 128)).astype(np.uint8).view("S128").ravel()).view(np.uint8).reshape(n, 128)
        columns = {"region": [7] * n, "n": [n] * n, "node": list(range(n)), "n_shingles": [9] * n, "component": list(range(n)), "levels": [x.tobytes() for x in levels]}
        out = list(near_dup.candidates(pa.table(columns).to_batches(max_chunksize=5), 0.16, 128, True))
        return {(a, b) for x in out for a, b in zip(x["a"].to_pylist(), x["b"].to_pylist())}

    few = run(near_dup.WINDOW + 1)
    assert len(few) == near_dup.WINDOW * (near_dup.WINDOW + 1) // 2
    many = run(60)
    assert {(i, i + 1) for i in range(59)} <= many and len(many) < 59 + near_dup.PIVOTS * 60


def test_shared_shingles_are_counted_exactly():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    shared = near_dup.Shared(sets)
    for s in sets:
        assert shared.counts(s).tolist() == [len(np.intersect1d(s, t)) for t in sets]


def test_words_of_equal_power_sums_make_two_sets(spark):
    texts = [w for n in (1024, 2048) for x, y in (("a", "b"), ("k", "q")) for w in alternating(n, x, y)]
    sets = words.shingle_sets(*words.word_hashes(pa.array([f"one two {t} three four" for t in texts])))
    assert len({s.tobytes() for s in sets}) == len(texts)
    got = near_dup.near_duplicates(docs(spark, texts)).collect()
    assert all(r["component_id"] == r["doc_id"] and r["n_shingles"] == 1 for r in got)


def test_near_empty_and_stage(spark):
    df = docs(spark, ["", None, "a b c d e f", "a b c d e f", "A B C D E F"])
    assert near_dup.near_duplicates(df.limit(0)).count() == 0
    assert sorted(r["doc_id"] for r in near_dup.drop_near_duplicates(df).collect()) == [0, 1, 2]
    assert near_dup.drop_near_duplicates(df).columns == df.columns
    assert near_dup.near_duplicates(df.filter("doc_id < 2")).filter("kept").count() == 2


def test_words_sets_and_estimates():
    rng = random.Random(2)
    bits = ["a", "B", "É", "the", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", "日本"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", "a" * 3_000_000 + " b", "q " * 700_000]
    sets = words.shingle_sets(*words.word_hashes(pa.array(texts)))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    together, counts = words.word_parts(pa.array(texts), words.SIGNS, (3, 6))  # through several windows
    alone = [words.word_parts(pa.array([t]), words.SIGNS, (3, 6)) for t in texts]
    assert counts.tolist() == [int(n[0]) for _, n in alone] and (together == np.concatenate([h for h, _ in alone], 1)).all()
    w = ["w%d" % i for i in range(1000)]
    pair = words.shingle_sets(*words.word_hashes(pa.array([" ".join(w), " ".join(w[100:])])))
    sig = words.signatures(pair, 480)
    true = len(np.intersect1d(*pair)) / len(np.union1d(*pair))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.07
