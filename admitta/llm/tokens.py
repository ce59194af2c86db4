"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Byte-level BPE ranks for many languages; a parameter of every operator that measures tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-tokenizer pattern published with byte-level BPE.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text; 0 for a null or empty one."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = encoder(vocabulary).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def sized_documents(documents: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The kept columns and ``n_tokens``."""
    return documents.select(*(F.col(f"`{c}`") for c in keep), F.col("text").alias("_text")).select(*(F.col(f"`{c}`") for c in keep), token_count(F.col("_text"), vocabulary).alias("n_tokens"))
