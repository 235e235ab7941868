"""The pipeline against its brute-force version."""

import corpus_pipeline
from tokenizers import Tokenizer

from metroloom.llm import toxicity
from metroloom.llm._shared import tokenizer_path

from .conftest import DATA
from .test_dedup import brute_components
from .test_tokens import check_pieces


def test_stages_and_result(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "packing"]
    d = DATA
    docs = spark.read.parquet(f"{d}/documents.parquet")
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, spark.read.parquet(f"{d}/labels.parquet")).filter("predicted = 1").collect()}
    left = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] not in bad}
    last = {}
    for i, t in left.items():
        last[t] = max(i, last.get(t, i))
    left = {i: t for i, t in left.items() if last[t] == i}
    comp = brute_components(list(left.items()), 80)
    left = {i: t for i, t in left.items() if comp[i][1] == i or comp[i][0] == 0}
    library = Tokenizer.from_file(tokenizer_path())
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in left.items()}
    assert check_pieces(corpus_pipeline.run(spark, d).collect(), ids, 1024) < 1024
