"""Token ids of whole texts, inside tasks."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np

#: Longest text, in characters, that is encoded in one call.
BLOCK = 1 << 18
END = 0
#: The special token of the named vocabulary, which has an id of its own (fixed value).
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """Parts of a text whose ids, joined, are the ids of the whole.

    A part ends before a single space between two ASCII letters, where the vocabulary's
    splitting pattern always begins a new piece. Without such a place a part grows on.
    """
    place = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
    start = 0
    while len(text) - start > size:
        found = place.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encoder(path: str | None = None, special: dict[str, int] | None = None) -> Callable[[str | None], np.ndarray]:
    """A function from a text (NULL: empty) to its ids and a closing ``END``.

    The ids are those of ``byte_bpe_50k.json`` with none added; its special token, where a text
    holds it, is one id. The same vocabulary, given as ranks, is run by the faster of the
    installed libraries. ``special`` names the special tokens of another vocabulary, or none.
    """
    import public_tokenizers
    import tiktoken

    with open(path or vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = SPECIAL if special is None else special
    encoding = tiktoken.Encoding(
        "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    def encode(text: str | None) -> np.ndarray:
        ids = [i for part in blocks(text) for i in encoding.encode(part, allowed_special="all")] if text else []
        ids.append(END)
        return np.array(ids, np.uint32)

    return encode
