"""Exact splitting of texts for byte-level BPE.

In the split pattern a space that a non-space follows always begins a match, so a text
may be cut there with ``str.split`` and each part matched alone: the parts of ordinary
text repeat, and a part's matches are found once per task. Texts in which a space ends the text or
stands before white space are matched whole.
"""
from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: A space before white space (any that Python or Unicode calls so) or at the end.
ODD = re.compile(r"\x20(?:[\s\x1c-\x1f\x85]|\Z)")
#: Marks that the split pattern matches alone behind a letter if nothing follows.
MARKS = frozenset(".,;:!?")


def parts(text: str) -> list[str] | None:
    """The text cut at its spaces: the first part as it stands, the others without their space. None: match the text whole."""
    return None if ODD.search(text) else text.split(" ")


def after_space(part: str, find: Callable[[str], list[str]]) -> list[str]:
    """The matches in a space and the part behind it. Letters, also with one mark after them, need no search."""
    if part.isalpha():
        return [" " + part]
    if part[-1:] in MARKS and part[:-1].isalpha():
        return [" " + part[:-1], part[-1]]
    return find(" " + part)


def matcher(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)
