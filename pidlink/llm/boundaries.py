"""Cutting texts where byte-level BPE tokenization cannot notice it.

Byte-level pre-tokenizers of this family match words with at most one leading space, runs of
white space only among themselves, and look ahead but never behind. So a text may be cut
before any space that follows a character other than white space: nothing before the cut
reaches beyond it, and what follows is matched as it would be in the whole text. The same
holds beside special strings, which contain no space.
"""

from __future__ import annotations

import re

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<!\s) ")


def safe_parts(text: str) -> list[str]:
    """Parts of a text: the first as it is, every other without the space it begins with."""
    return _CUT.split(text) if _SPACE_AFTER_SPACE.search(text) else text.split(" ")
