"""Byte-level BPE over space-led chunks.

A single space followed by a non-space always opens a new pre-token of the
byte-level pattern, whatever stands before it. So a text cut in front of such
spaces gives chunks whose tokens do not depend on their neighbours, and a chunk
seen before needs a dictionary look-up instead of a merge run.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

#: A space that another white space (or the end) follows opens no pre-token.
#: Python's \\s holds every character the tokenizer counts as white space.
_UNSAFE = re.compile(r" (?:\s|$)")
_SAFE_SPACE = re.compile(r" (?=\S)")


def chunks(text: str) -> list[str]:
    """Chunks of a text; each but the first has lost its leading space."""
    return _SAFE_SPACE.split(text) if _UNSAFE.search(text) else text.split(" ")


def stretches(text: str, least: int) -> Iterator[str]:
    """The text cut in front of spaces that open a pre-token, into stretches of at
    least ``least`` characters (the last may be shorter): their tokens, one after the
    other, are those of the text."""
    start = 0
    while cut := _SAFE_SPACE.search(text, start + least):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def vocabulary_path(name: str) -> str:
    """Where a vocabulary file is on this machine (a path is taken as it is)."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(name: str):
    """The tokenizer of a .json file, once per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(name))


@lru_cache(maxsize=4)
def special_strings(name: str) -> re.Pattern | None:
    """Pattern of the added tokens the tokenizer finds inside texts."""
    added = [t.content for t in tokenizer(name).get_added_tokens_decoder().values()]
    return re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None


@lru_cache(maxsize=4)
def rank_encoder(name: str):
    """The same vocabulary as merge ranks: a faster merge run for chunks of
    Latin letters, where both libraries' character classes agree."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(vocabulary_path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, name: str) -> list[str]:
    """The text cut at the tokenizer's added tokens; odd entries are those."""
    pattern = special_strings(name)
    return pattern.split(text) if pattern and pattern.search(text) else [text]
