"""Token counts with a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file (ranks) used unless another is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE cuts a text into words before merging.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def tokenizer(path: str = VOCABULARY) -> tiktoken.Encoding:
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_lengths(path: str = VOCABULARY) -> np.ndarray:
    """Length in bytes of each token, by its number."""
    enc = tokenizer(path)
    out = np.zeros(enc.n_vocab, np.int64)
    for token in enc.token_byte_values():
        out[enc.encode_single_token(token)] = len(token)
    return out


def token_ends(text: str, path: str = VOCABULARY) -> np.ndarray:
    """Offset in UTF-8 bytes after each token of ``text``."""
    return np.cumsum(token_lengths(path)[tokenizer(path).encode_ordinary(text)])


def token_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``docs`` (with ``text``) with ``n_tokens`` in place of ``text``: null for null, 0 for empty."""
    rest = [c for c in docs.columns if c != "text"]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokenizer(path)
        for batch in batches:
            n = [None if t is None else len(enc.encode_ordinary(t)) for t in batch["text"]]
            yield batch[rest].assign(n_tokens=pd.array(n, "Int64"))

    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).schema.add("n_tokens", "long")
    return docs.select(*[F.col(f"`{c}`") for c in rest], "text").mapInPandas(count, schema)
