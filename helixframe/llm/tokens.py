"""Token ids of documents, and the bounded windows in which the packers work.

ids come from the byte-level BPE that `tokenizers` reads from a vocabulary file. tiktoken encodes the
same vocabulary, kept as ranks beside it, several times faster, and gives the same ids (a test holds
them against each other); a text with a special token's string goes through `tokenizers` itself, which
reads that string as the special token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Every document ends with this id.
END_ID = 0


@dataclass(frozen=True)
class Vocabulary:
    """Paths of the two files; both must exist on every executor."""

    json: str
    ranks: str
    special: tuple[str, ...] = ("<|endoftext|>",)


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@lru_cache(maxsize=2)
def _coders(vocabulary: Vocabulary):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(vocabulary.ranks, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, Tokenizer.from_file(vocabulary.json)


def encode(text: str | None, vocabulary: Vocabulary) -> np.ndarray:
    """ids of a whole text and END_ID, little-endian unsigned 32-bit. Null counts as empty."""
    fast, exact = _coders(vocabulary)
    text = text or ""
    if any(s in text for s in vocabulary.special):
        ids = exact.encode(text, add_special_tokens=False).ids
    else:
        try:
            ids = fast.encode_ordinary(text)
        except UnicodeEncodeError:  # a lone surrogate
            ids = exact.encode(text, add_special_tokens=False).ids
    return np.array([*ids, END_ID], "<u4")


def windows(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, tokens: int, documents: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """doc_ids and ids of successive documents of a task, up to a bounded number of tokens and documents at a time."""
    keys: list = []
    ids: list[np.ndarray] = []
    held = 0
    for b in batches:
        for key, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            keys.append(key)
            ids.append(encode(text, vocabulary))
            held += len(ids[-1])
            if held >= tokens or len(keys) >= documents:
                yield keys, ids
                keys, ids, held = [], [], 0
    if keys:
        yield keys, ids
