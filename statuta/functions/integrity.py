"""Signs of damage in one text, seen without others beside it."""

from __future__ import annotations

import re

#: Wrong decoding, replaced characters and character entities that should have been resolved.
BROKEN = re.compile(r"�|Ã[\u0080-¿Œ-˜‐-™]|Â[\u0080-¿]|â€|â‚¬|&(?:[A-Za-z][A-Za-z0-9]{1,9}|#\d{1,6}|#x[0-9A-Fa-f]{1,6});")
#: How a whole body may end: a sentence, or an item of a list.
ENDS = re.compile(r"(?:[.;,:!?)\]“”\"…]|\b(?:und|oder|sowie))\s*\Z")


def repeats(text: str) -> bool:
    """Whether the text is the same part twice, or repeats one of its longer lines."""
    n = len(text)
    for gap in (0, 1, 2):
        if n > 40 and (n - gap) % 2 == 0 and (h := (n - gap) // 2) and text[:h] == text[h + gap :] and not text[h : h + gap].strip():
            return True
    lines = [x.strip() for x in text.split("\n") if len(x.strip()) > 40]
    return len(set(lines)) < len(lines)


def broken_characters(text: str) -> bool:
    return bool(BROKEN.search(text))


def cut_off(text: str) -> bool:
    return not ENDS.search(text)
