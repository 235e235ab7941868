import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from metroloom.llm import bpe, packing, queries
from metroloom.llm._shared import tokenizer_path

from .conftest import DATA, docs


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(tokenizer_path())


def same(codec, library, texts):
    ids, offsets = codec.encode_batch(texts)
    for t, i, j in zip(texts, offsets[:-1], offsets[1:]):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[i:j].tolist() == want, repr(t)
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


def test_ids_equal_the_librarys(codec, library):
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'re", "'", "'ll", "'vE", "a", "B", "é", "字", "𝒳", "1", "²", "<|endoftext|>", "<|", "!!", "…", "\0", "the", "ing", "aaaa", "ª", "Ⅷ", "٣"]
    same(codec, library, ["".join(rng.choice(bits) for _ in range(rng.randint(0, 50))) for _ in range(4000)])
    same(codec, library, ["a" * n for n in range(80)] + ["ab" * n for n in range(60)] + ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 60))) for _ in range(3000)])
    same(codec, library, ["".join(map(chr, rng.choices([*range(1, 0xD7FF), *range(0xE000, 0x10FFFF)], k=15))) for _ in range(1500)])
    same(codec, library, ["", "x " * 700_000, "word" * 20_000, "z" * 1_500_000, "y " + "x" * 3_000_000 + "z z"])


def alternating(n, x, y):
    """Words on which sums of powers modulo 2**64 agree, though no sign is at the same place."""
    return ["".join((x, y)[bin(i).count("1") % 2 ^ flip] for i in range(n)) for flip in (0, 1)]


def test_words_of_equal_hashes_keep_their_own_ids(codec, library, monkeypatch):
    pairs = [("a", "b"), ("e", "t"), ("1", "2"), ("!", "?"), ("é", "ü")]
    texts = [w for n in (1024, 2048) for x, y in pairs for w in alternating(n, x, y)]
    same(codec, library, texts)
    same(codec, library, [" ".join(texts)])
    monkeypatch.setattr(bpe, "span_hashes", lambda data, starts, stops: (stops - starts).astype(np.uint64))
    codec._forget()
    same(codec, library, ["all the words of one length share a hash here", "so most must be told apart", *texts[:4]])
    codec._forget()


def test_every_merge_order_is_the_exact_one(codec):
    words = [t for t in codec.token_bytes[:2000] if t] + [b"hellohello", b"aaaaaaa", b"\xff\xfe"]
    flat = np.frombuffer(b"".join(words), np.uint8), np.cumsum(list(map(len, words)))
    ids, counts, failed = codec.encode_words(*flat)
    exact, which = codec.merge_all(*flat)
    assert ids.tolist() == exact.tolist() and counts.tolist() == np.bincount(which, minlength=len(words)).tolist() and failed < len(words)


def test_frames(spark, codec, library, odd_texts):
    df = docs(spark, odd_texts)
    enc = bpe.encode(df, tokenizer_path())
    assert enc.columns == [*df.columns, "ids"] and bpe.encode(enc, tokenizer_path()).columns == enc.columns
    back = bpe.decode(enc, tokenizer_path()).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back) and len(back) == len(odd_texts)
    assert bpe.roundtrip(df.limit(0), tokenizer_path()).count() == 0
    assert digests(bpe.roundtrip(df, tokenizer_path())) == library_digests(library, enumerate(odd_texts))


def digests(df):
    return {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect()}


def library_digests(library, rows):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    return {i: (len(x), sha(",".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}


def test_query_equals_the_library(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert digests(queries.op10_bpe(spark, DATA)) == library_digests(library, rows)


def check_pieces(rows, ids_of, window):
    """Each id in one piece, offsets gapless, CRCs right; returns padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == ids_of.keys()
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            own = ids_of[d][p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and len(own) == p["length"] > 0 and p["doc_tokens"] == len(ids_of[d])
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += p["length"]
        assert at == len(ids_of[d])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padding += window - at
    return padding


@pytest.mark.parametrize("window", [1024, 16])
def test_packing(spark, library, odd_texts, window):
    texts = [*odd_texts, *odd_texts, *("word " * n for n in range(200))]
    rows = packing.pack(docs(spark, texts), tokenizer_path(), window=window).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert check_pieces(rows, ids, window) < window


def test_packing_of_nothing_and_of_repeated_rows(spark):
    df = docs(spark, ["a b", None])
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0
    rows = packing.pack(df.union(df), tokenizer_path()).collect()
    assert len(rows) == 4 and sorted(r["offset"] for r in rows)[0] == 0


def test_packing_query(spark, library):
    rows = queries.op9_packing(spark, DATA).collect()
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert check_pieces(rows, ids, 1024) < 1024


def test_least_squares_uses_what_there_is():
    rng = np.random.default_rng(0)
    h = np.zeros(64, np.int64)
    h[1:] = rng.integers(0, 500, 63)
    slots, taken, sequences = packing.plan(h, 64)
    assert (taken <= h).all() and taken.sum() > 0.7 * h.sum()
    fill = {}
    for length, first, n, sequence, offset in slots:
        for k in range(n):
            fill.setdefault(sequence + k, []).append((offset, length))
    assert len(fill) == sequences
    for parts in fill.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 64
