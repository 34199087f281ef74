"""Counting tokens with a public byte-level tokenizer; its file is a parameter and stays where it is."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: A vocabulary as ranks: a token in base 64 and its number on each line.
DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the tokenizer's text is cut before its pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def encoding(path: str):
    """The tokenizer of a file; built once a worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path.rpartition("/")[2], pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(4)
def token_bytes(path: str) -> np.ndarray:
    """Number of bytes of each token."""
    e = encoding(path)
    return np.array([len(e.decode_single_token_bytes(i)) for i in range(e.n_vocab)], dtype=np.int64)


def clean(text: str) -> str:
    """Lone surrogates, which have no bytes, count as the replacement character."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def count(text: str, path: str) -> int:
    return len(encoding(path).encode_ordinary(clean(text)))
