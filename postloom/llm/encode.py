"""Token ids of a whole corpus by a public tokenizer.

The vocabulary is a tiktoken rank file whose path is a parameter; it is read
once in each Python worker.  Very long texts are cut before encoding, only
where the tokenizer's own pattern ends a piece whatever stands around, so the
ids are those of the whole text.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.session import ship_active, spread_out

#: Folder of the public vocabularies; the environment may name another.
TOKENIZER_DIR = os.environ.get("POSTLOOM_TOKENIZERS", "/opt/tokenizers")
DEFAULT_RANKS = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
# Fixed value: the pre-splitting pattern that belongs to these vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Texts above this many characters are cut; the pieces are about so long.
LONG_TEXT = 20_000
#: Between a sign and white space the pattern always ends a piece.
BOUNDARY = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def encoding(path: str = DEFAULT_RANKS, pattern: str | None = None):
    """The tokenizer of a rank file, without special tokens."""
    import tiktoken

    if pattern is None:
        try:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        except (ImportError, AttributeError):
            pattern = PATTERN
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = LONG_TEXT) -> Iterator[str]:
    """Consecutive parts of a text that may be encoded one by one."""
    start = 0
    while len(text) - start > limit:
        cut = BOUNDARY.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str | None, path: str = DEFAULT_RANKS) -> list[int]:
    """Ids of one text; none for null and empty texts.  Strings that look like special tokens are ordinary text."""
    if not text:
        return []
    ordinary = encoding(path).encode_ordinary
    if len(text) <= LONG_TEXT:
        return ordinary(text)
    return [i for part in pieces(text) for i in ordinary(part)]


def decode_ids(ids: list[int], path: str = DEFAULT_RANKS) -> bytes:
    """The bytes behind ids, exactly as they were encoded."""
    return encoding(path).decode_bytes(list(ids))


def token_ids(text: Column, path: str = DEFAULT_RANKS) -> Column:
    """Array of ids of a text column."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([encode_text(t, path) for t in texts])

    ship_active()
    return F.pandas_udf(run, "array<bigint>")(text)


def token_count(text: Column, path: str = DEFAULT_RANKS) -> Column:
    """Number of ids of a text column; 0 for null and empty texts."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([len(encode_text(t, path)) for t in texts], dtype="int64")

    ship_active()
    return F.pandas_udf(run, "bigint")(text)


def encoded(docs: DataFrame, path: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, ids) for every document; no shuffle."""
    return spread_out(docs.select("doc_id", "text")).select("doc_id", token_ids(F.col("text"), path).alias("ids"))
