import os
import random

import duckdb
import pytest

DATA = os.environ.get("METROLOOM_ORACLE_DATA", "/root/testdata/sf0.01")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, start=0):
    """A documents table; extra columns have names that operators use inside."""
    rows = [(start + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("digest", "run", "uid", "key", "node", "shard", "size", "cls", "rest", "__key", "kept", "score"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df.repartition(3)


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgé ") for _ in range(rng.randint(1, 9)))
    long = " ".join(word() for _ in range(30_000))
    return [None, "", " ", "same text", "same text", "same text", None, "", "Don't  stop\n\n<|endoftext|>", "日本語 テキスト", long, "x" * 50_000, *(" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(25))]


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        path = f"{DATA}/{f}"
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c
