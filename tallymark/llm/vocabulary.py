"""Public vocabulary files: where they are, and their merge tables.

The files are read by path and never copied. They are the same on every machine that
has the ``public_tokenizers`` package; ``path`` may name any other file of the same form.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import public_tokenizers
import regex

WORDS = regex.compile(public_tokenizers.PATTERN)

# The Unicode White_Space characters, which \s means in the split pattern.
BLANK = "\t-\r \x85\xa0  -     　"
# Splits at blanks as the split pattern does, so that a chunk can be split further on its own.
CHUNKS = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


def vocabulary_path(name: str) -> str:
    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the .json vocabulary.

    Printable bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    letters, spare = [], 256
    for byte in range(256):
        if byte in printable:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


@lru_cache(maxsize=2)
def json_merges(path: str) -> tuple[list[int], dict[int, int], tuple[str, ...]]:
    """Of a .json vocabulary: the symbol of each byte, pair -> (rank, merged symbol), special strings.

    A pair is packed as ``left << 16 | right``, its value as ``rank << 16 | merged``.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids = content["model"]["vocab"]
    pairs = {}
    for rank, (left, right) in enumerate(content["model"]["merges"]):
        pairs[ids[left] << 16 | ids[right]] = rank << 16 | ids[left + right]
    specials = tuple(token["content"] for token in content["added_tokens"])
    return [ids[letter] for letter in byte_letters()], pairs, specials


@lru_cache(maxsize=2)
def token_ranks(path: str) -> dict[bytes, int]:
    """Of a .tiktoken vocabulary: the rank, which is also the id, of each token's bytes."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
