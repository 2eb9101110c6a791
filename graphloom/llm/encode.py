"""Encoding and decoding of whole corpora with a public byte-level tokenizer.

Texts go through the tokenizers library in Arrow batches that are bounded in characters, so that a very long text is a batch
of its own. Decoding reverses the byte-to-character table of the vocabulary and joins the bytes before it reads them as UTF-8,
so a character split over two tokens comes back whole.

Cases: null and empty texts both give an empty list; special tokens' strings are ordinary text; lone surrogates cannot occur
in a Spark string; repeated rows give equal lists.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary's file; another folder is named by the environment, another file by the parameter ``path``.
TOKENIZER = os.path.join(os.environ.get("GRAPHLOOM_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.json")
#: Characters of text encoded at once.
BATCH_CHARS = 2_000_000


@functools.cache
def tokenizer(path: str = TOKENIZER):
    """The tokenizer of a file, once a process, on the task's own thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@functools.cache
def byte_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 signs stand for themselves, the
    other bytes for the characters from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def decode_bytes(ids: list[int], path: str = TOKENIZER) -> bytes:
    """The exact bytes of a list of ids."""
    t, table = tokenizer(path), byte_table()
    return bytes(table[c] for i in ids for c in t.id_to_token(i))


def decode(ids: list[int], path: str = TOKENIZER) -> str:
    """The text of a list of ids; bytes that are no whole character (a cut list) become replacement signs."""
    return decode_bytes(ids, path).decode("utf-8", errors="replace")


def _slices(texts: list[str]) -> Iterator[list[str]]:
    at, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > BATCH_CHARS:
            yield texts[at:i]
            at, chars = i, 0
        chars += len(t)
    yield texts[at:]


def encode_batch(texts: list[str | None], path: str = TOKENIZER) -> list[list[int]]:
    """The ids of each text."""
    t = tokenizer(path)
    return [e.ids for part in _slices([x or "" for x in texts]) for e in (t.encode_batch_fast(part, add_special_tokens=False) if part else [])]


def encode_offsets(text: str | None, path: str = TOKENIZER) -> list[tuple[int, int, int]]:
    """(id, first, end) of each token, in characters of the text; tokens of one split character share its span."""
    e = tokenizer(path).encode(text or "", add_special_tokens=False)
    return [(i, a, b) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]


def encode(df: DataFrame, key: str, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """(key, ids) of every row of ``df``: one narrow pass, no shuffle."""
    kind = df.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([(key, to_arrow_type(kind)), ("ids", pa.list_(pa.int32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = encode_batch(b.column(1).to_pylist(), path)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return df.select(key, F.col(text).alias("_text")).mapInArrow(work, f"`{key}` {kind.simpleString()}, ids array<int>")


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str = TOKENIZER) -> DataFrame:
    """Adds the number of tokens of each text (0 for null and empty)."""
    @F.pandas_udf("long")
    def sizes(texts: pd.Series) -> pd.Series:
        return pd.Series([len(x) for x in encode_batch(texts.tolist(), path)], dtype="int64")

    return df.withColumn(out, sizes(F.col(text)))
