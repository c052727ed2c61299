"""Splitting texts into the pieces that byte-pair encoders merge separately.

The patterns of the tokenizers use Unicode letter, number and white-space classes. Python's own
`re` has no such classes, but is several times faster than engines that do, so the classes are
spelled out for the basic plane from the Unicode database. Texts with characters beyond it go to
the `regex` module.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import regex

BASIC_PLANE = 0x10000


def _ranges(member: Callable[[str], bool]) -> str:
    """The members of the basic plane as the inside of a character class."""
    spans: list[list[int]] = []
    for code in range(BASIC_PLANE):
        if member(chr(code)):
            if spans and spans[-1][1] == code - 1:
                spans[-1][1] = code
            else:
                spans.append([code, code])
    return "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in spans)


@lru_cache(maxsize=1)
def _classes() -> tuple[str, str, str]:
    letters = _ranges(lambda char: unicodedata.category(char)[0] == "L")
    numbers = _ranges(lambda char: unicodedata.category(char)[0] == "N")
    spaces = _ranges(
        lambda char: unicodedata.category(char)[0] == "Z" or "\t" <= char <= "\r" or char == "\x85"
    )
    return letters, numbers, spaces


def _basic_plane_pattern(pattern: str) -> re.Pattern:
    r"""The pattern with `\p{L}`, `\p{N}` and `\s` spelled out, inside and outside of classes."""
    letters, numbers, spaces = _classes()
    spelled, inside, at = [], False, 0
    tokens = {r"\p{L}": letters, r"\p{N}": numbers, r"\s": spaces}
    while at < len(pattern):
        token = next((t for t in tokens if pattern.startswith(t, at)), None)
        if token:
            spelled.append(tokens[token] if inside else f"[{tokens[token]}]")
            at += len(token)
        elif pattern.startswith(r"\S", at) and not inside:
            spelled.append(f"[^{spaces}]")
            at += 2
        else:
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            spelled.append(pattern[at])
            at += 1
    return re.compile("".join(spelled))


@lru_cache(maxsize=8)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that gives all matches of a tokenizer pattern in a text."""
    basic = _basic_plane_pattern(pattern).findall
    beyond = regex.compile(_with_white_space(pattern)).findall
    outside = re.compile(f"[{chr(BASIC_PLANE)}-{chr(sys.maxunicode)}]").search

    def split(text: str) -> list[str]:
        if not outside(text):
            return basic(text)
        return beyond(text)

    return split


def _with_white_space(pattern: str) -> str:
    r"""`\s` as the property White_Space, inside and outside of classes."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
