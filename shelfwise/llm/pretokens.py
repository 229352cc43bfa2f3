"""Splitting text into units that byte-level tokenizers treat separately."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex
from public_tokenizers import PATTERN
from tokenizers import pre_tokenizers

_PATTERN = regex.compile(PATTERN)
#: A space that does not stand between two other characters: the next unit may reach across it.
_LOOSE_SPACE = re.compile(r"\s | \s|^ | $")
#: Outside these ranges the installed regex module may know newer letters than the tokenizer libraries.
_SETTLED = re.compile("[^\\x00-ԯ -⁯₠-₿　-ヿ一-龥가-힣]")
_LIBRARY = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def _by_library(text: str) -> list[str]:
    return [text[a:b] for _, (a, b) in _LIBRARY.pre_tokenize_str(text)]


def splitter(text: str) -> Callable[[str], list[str]]:
    """What splits ``text``, or any piece of it, into the public pattern's matches as the tokenizer libraries do."""
    return _by_library if _SETTLED.search(text) else _PATTERN.findall


def pretokens(text: str) -> list[str]:
    """The matches of the public pattern in order; they join to the text."""
    return splitter(text)(text)


def units(text: str, split: Callable[[str], list[str]]) -> list[str]:
    """Consecutive pieces whose pre-tokens can be found one piece at a time.

    A space between two non-space characters always starts a pre-token, so a text without
    other uses of space is cut there, which is much cheaper than matching the pattern.
    """
    if _LOOSE_SPACE.search(text):
        return split(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + x for x in rest]
