"""Token ids of whole texts inside tasks.

The ids are those of the byte-level vocabulary file for the ``tokenizers``
library.  They are computed with ``tiktoken`` on the same vocabulary (its rank
file), which takes a quarter of the time; ``tests/llm`` compares both on prose,
odd bytes and white space.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

END_OF_TEXT = "<|endoftext|>"


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def json_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def _fast(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)}
    )


@lru_cache(maxsize=2)
def reference_tokenizer(path: str):
    """The tokenizer of the JSON file, for texts the fast one refuses and for tests."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of one text as unsigned 32-bit integers; a null text is an empty one.

    The string of the end-of-text token inside a text gives that token's id,
    as the JSON tokenizer does by default.
    """
    if not text:
        return np.empty(0, dtype="<u4")
    fast = _fast(path or rank_file())
    try:
        ids = fast.encode(text, allowed_special="all") if END_OF_TEXT in text else fast.encode_ordinary(text)
    except BaseException as e:  # a panic of the regex engine, on some runs of a million equal characters
        if path is not None or type(e).__name__ not in ("PanicException", "ValueError"):
            raise  # only the default vocabulary has a second tokenizer
        ids = reference_tokenizer(json_file()).encode(text, add_special_tokens=False).ids
    return np.array(ids, dtype="<u4")
