"""Ids of the byte-level BPE vocabulary, shared by token counts and packing.

Two libraries know the same vocabulary. `tokenizers` defines the ids;
`tiktoken`, several times faster, gives the same ids wherever both split text
alike, which the tests check for every character below U+0250. Texts with any
other character go through `tokenizers`.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable

import numpy as np

JSON_FILE, RANKS_FILE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}  # fixed value: the vocabulary's only special token


def vocabulary(folder: str | None, name: str) -> str:
    """Place of a vocabulary file: in a given folder, or that of the public tokenizers."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(folder: str | None = None) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids (uint32); to be made inside a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary(folder, JSON_FILE))
    with open(vocabulary(folder, RANKS_FILE), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=SPECIAL)
    allowed, unusual = set(SPECIAL), re.compile("[^\x00-ɏ]")

    def ids(text: str) -> np.ndarray:
        if text.isascii() or unusual.search(text) is None:
            return fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
        return np.asarray(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return ids
