import random
import zlib

import numpy as np

from metroloom.llm import toxicity

from .conftest import docs


def corpus(n=900):
    rng = random.Random(1)
    calm = ["w%d" % i for i in range(300)]
    stems = ["vilefoo", "nastybar", "grimbaz"]
    texts, toxic = [], []
    for _ in range(n):
        bad = rng.random() < 0.2
        w = [rng.choice(calm) for _ in range(rng.randint(20, 60))]
        if bad:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(stems) + rng.choice(["", "s", "ing", "ed", "er"])
        texts.append(" ".join(w) + ".")
        toxic.append(int(bad))
    return texts, toxic


def test_held_out_accuracy_and_edge_cases(spark):
    texts, toxic = corpus()
    odd = [None, "", "vilefoo " * 50_000]
    df = docs(spark, texts + odd)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(df, labels)
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, labels, model=model).collect()}
    assert len(got) == len(texts) + 3
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    held = [i for i in range(len(texts)) if got[i]["held_out"]]
    right = sum(got[i]["predicted"] == toxic[i] for i in held) / len(held)
    caught = sum(got[i]["predicted"] for i in held if toxic[i]) / sum(toxic[i] for i in held)
    assert right > 0.95 and caught > 0.85
    assert got[len(texts)]["score"] == got[len(texts) + 1]["score"] and got[len(texts) + 2]["predicted"] == 1
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] == 0 for r in got.values())


def test_without_positives_and_without_rows(spark):
    df = docs(spark, ["a b", "c d"])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.toxicity(df, none).collect()] == [0, 0]
    assert toxicity.toxicity(df.limit(0), none).count() == 0


def test_steps_follow_the_corrected_risk(monkeypatch):
    """One batch an epoch: each step is that of Adam on the non-negative risk, written out term by term."""
    rng = np.random.default_rng(4)
    positive_x, unlabelled_x = rng.random((40, 6)) < 0.6, rng.random((60, 6)) < 0.3
    sparse = lambda x: toxicity.Sparse(np.nonzero(x)[1], np.cumsum(x.sum(1)) - x.sum(1), x.sum(1))
    for name, value in {"BITS": 3, "EPOCHS": 80, "BATCH": 60, "DEVIATIONS": -1, "SHARE": 0.0}.items():
        monkeypatch.setattr(toxicity, name, value)
    prior, corrected = 0.7, 0
    w, b = toxicity.fit(sparse(positive_x), sparse(unlabelled_x), prior, 7)
    draw = np.random.default_rng(7)
    theta, m, v = np.append(np.zeros(6), np.log(prior / (1 - prior))), np.zeros(7), np.zeros(7)
    for t in range(1, 81):
        order = draw.permutation(60)
        p, u = np.c_[positive_x[draw.integers(0, 40, 40)], np.ones(40)], np.c_[unlabelled_x[order], np.ones(60)]
        s = lambda x: 1 / (1 + np.exp(-x @ theta))
        rest = -np.log(1 - s(u)).mean() + prior * np.log(1 - s(p)).mean()  # R_u of class 0, less the prior's share
        grad_rest = (s(u)[:, None] * u).mean(0) - prior * (s(p)[:, None] * p).mean(0)
        grad = prior * ((s(p) - 1)[:, None] * p).mean(0) + grad_rest if rest >= 0 else -grad_rest
        corrected += rest < 0
        grad = grad + np.append(toxicity.RIDGE * theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - toxicity.RATE * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * m / (np.sqrt(v) + 1e-6)
    assert np.allclose(np.append(w[:6], b), theta, atol=1e-9)
    assert corrected
