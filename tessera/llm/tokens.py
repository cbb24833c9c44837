"""Token counts and offsets by a public byte-level tokenizer.

The vocabulary file is read where the work is done; its path is a parameter.
"""

from __future__ import annotations

import base64
import functools
import os

import numpy as np

#: Where the public vocabularies lie; a file of ranks in tiktoken's format.
DEFAULT_VOCABULARY = os.environ.get("TESSERA_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pre-tokenization pattern that belongs to the 50k byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=2)
def encoding(path: str = DEFAULT_VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _clean(text: str) -> str:
    """Text without lone surrogates, which have no UTF-8 form."""
    return text.encode("utf-8", "replace").decode("utf-8")


def encode(text: str, path: str = DEFAULT_VOCABULARY) -> list[int]:
    enc = encoding(path)
    try:
        return enc.encode_ordinary(text)
    except UnicodeEncodeError:
        return enc.encode_ordinary(_clean(text))


def count(text: str | None, path: str = DEFAULT_VOCABULARY) -> int:
    """Tokens of a text; null and empty have none."""
    return len(encode(text, path)) if isinstance(text, str) and text else 0


@functools.lru_cache(maxsize=2)
def _widths(path: str) -> np.ndarray:
    enc = encoding(path)
    return np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)], dtype=np.int64)


def offsets(text: str, path: str = DEFAULT_VOCABULARY) -> np.ndarray:
    """Character offset of each token's start, and of the end of the text.

    A token that starts inside a character has the offset -1.
    """
    ids = np.array(encode(text, path), dtype=np.int64)
    ends = np.concatenate(([0], np.cumsum(_widths(path)[ids]))) if len(ids) else np.zeros(1, np.int64)
    if ends[-1] == len(text):
        return ends
    data = np.frombuffer(_clean(text).encode("utf-8"), dtype=np.uint8)
    first = (data & 0xC0) != 0x80
    place = np.append(np.where(first, np.cumsum(first) - 1, -1), len(text))
    return place[ends]
