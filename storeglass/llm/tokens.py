"""Token ids of whole texts by a public byte-level vocabulary, for use inside tasks."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

END_OF_TEXT = "<|endoftext|>"


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of an installed public vocabulary; it has to be installed on the executors too."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str):
    """text -> uint32 ids, the same as Tokenizer.encode(text, add_special_tokens=False) of the library `tokenizers`
    gives for the .json form of the vocabulary (test_packing.py compares them), several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    special = {END_OF_TEXT: len(ranks)}
    coding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if END_OF_TEXT in text:  # the vocabulary holds it as one added token
            return np.asarray(coding.encode(text, allowed_special="all"), np.uint32)
        return coding.encode_to_numpy(text, disallowed_special=())

    return encode
