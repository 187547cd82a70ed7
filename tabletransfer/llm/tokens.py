"""Token ids of texts, inside tasks."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

#: A vocabulary file for the tokenizers library; its ranks for tiktoken lie beside it.
VOCABULARY = "byte_bpe_50k.json"


@functools.lru_cache(4)
def encoder(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    """The byte-level vocabulary as ranks, which gives the same ids several times as fast."""
    path = public_tokenizers.path(vocabulary.removesuffix(".json") + ".tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(4)
def _tokenizer(vocabulary: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


@functools.lru_cache(4)
def special_ids(vocabulary: str = VOCABULARY) -> dict[str, int]:
    """Strings that the tokenizers library turns into one special id, as it does by default."""
    added = _tokenizer(vocabulary).get_added_tokens_decoder()
    return {token.content: number for number, token in added.items()}


def token_ids(column: pa.Array, vocabulary: str = VOCABULARY) -> Iterator[np.ndarray]:
    """One array of ids per text (null: none), equal to those of the tokenizers library."""
    encoding, specials = encoder(vocabulary), special_ids(vocabulary)
    for text in column:
        text = text.as_py() or ""
        if any(s in text for s in specials):
            ids = _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
        else:
            ids = encoding.encode_to_numpy(text, disallowed_special=())
        yield np.asarray(ids, np.uint32)
