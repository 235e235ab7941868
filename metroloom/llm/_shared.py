"""Scratch tables, Arrow helpers and the tokenizer path shared by the operators here."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import dealt, materialise, scratch, shared_dir

__all__ = ["blocks", "dealt", "keep_rows", "materialise", "scratch", "shared_dir", "strings", "tokenizer_path"]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file (never copied into this repository)."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


def strings(column: pa.Array) -> pa.Array:
    """A string column without nulls (null counts as empty)."""
    column = column.cast(pa.string()) if column.type != pa.string() else column
    return column.fill_null("") if column.null_count else column


def blocks(column: pa.Array, rows: int = 512, limit: int = 1 << 20) -> Iterator[pa.Array]:
    """Slices of a string column of at most ``rows`` rows and about ``limit`` bytes; a longer text is alone."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (held + n > limit or i - start >= rows):
            yield column.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(column):
        yield column.slice(start)


def keep_rows(df: DataFrame, stays: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is a key of ``stays``, all columns as they are."""
    name = "__key"
    while name in {c.lower() for c in df.columns}:
        name += "_"
    return df.join(stays.select(F.col(key).alias(name)).distinct(), F.col(key).eqNullSafe(F.col(name)), "left_semi")
