"""The consistent form of a text: precomposed letters, plain digits, hyphens and spaces, nothing invisible.

Two texts that look alike have the same consistent form. The rule works word by word (a word is a run of letters,
marks and ignorable characters):

* ignorable characters are dropped, special spaces become U+0020, special hyphens U+002D;
* width variants, ligatures and number letters become their plain letters and digits;
* letters and combining marks are composed (NFC);
* in a word that mixes Latin letters with look-alikes of other scripts, the look-alikes become Latin letters.
  Words wholly in another script stay as they are, as do single foreign letters.

Superscripts, dashes and wrongly decoded text look different from plain text and stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Look-alike letters of other scripts and the Latin letters they look like.
LOOKALIKE_FROM = "ɑɡɩʏɪаеорсухѕіјһԁԛԝӓӧёїАВЕКМНОРСТХЅІЈУӒӦЁΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοօοսհոѵꜱ"
LOOKALIKE_TO = "agıyiaeopcyxsijhdqwäöëïABEKMHOPCTXSIJYÄÖËABEZHIKMNOPTYXvooouhnvs"
LOOKALIKE = dict(zip(LOOKALIKE_FROM, LOOKALIKE_TO, strict=True))
# Spaces that look like U+0020, hyphens that look like U+002D.
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "‐‑﹣"
# Character ranges whose members show nothing.
IGNORABLE_CLASS = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff"
#: Characters that a text in consistent form may lack; a text without any of them needs no work (also a Java class).
ODD_CLASS = (
    r"\u00a0\u00ad\u0250-\u02af\u0300-\u036f\u0370-\u058f\u061c\u115f\u1160\u1680\u17b4\u17b5\u180b-\u180e\u1ab0-\u1aff\u1dc0-\u1dff"
    r"\u2000-\u2011\u2028-\u202f\u205f-\u206f\u20d0-\u20ff\u2126\u212a\u212b\u2160-\u217f\u3000\ua731\ufb00-\ufb06\ufe00-\ufe0f\ufe63\ufeff\uff01-\uff5e"
)
# the long class is tried only on characters beyond ASCII, which one comparison finds
ODD_JAVA = f"[^\\x00-\\x9f](?<=[{ODD_CLASS}\\x{{1d400}}-\\x{{1d7ff}}])"
#: Finds texts with an odd character in one pass: runs of Latin letters, runs of others that are not odd, then any character.
HAS_ODD_JAVA = f"(?s)^(?:[\\x00-\\x9f\\xa1-\\xac\\xae-\\xff]++|[^\\x00-\\xff{ODD_CLASS}\\x{{1d400}}-\\x{{1d7ff}}]++)*+."
ODD = re.compile(f"[{ODD_CLASS}\U0001d400-\U0001d7ff]")
IGNORABLE = re.compile(f"[{IGNORABLE_CLASS}]")
#: A word with its marks and ignorables; what stands between words is treated character by character.
WORD = re.compile(rf"(?:[^\W\d_]|[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff{IGNORABLE_CLASS}])+")
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏḀ-ỿ]")
_FOREIGN = re.compile(r"[ɐ-ʯͰ-֏ꜱ]")


def plain_char(ch: str) -> str:
    """The plain spelling of one character by table, without look at its word (look-alike letters stay)."""
    if ch in SPACES:
        return " "
    if ch in HYPHENS:
        return "-"
    o = ord(ch)
    if 0xFF01 <= o <= 0xFF5E or 0xFB00 <= o <= 0xFB06 or 0x2160 <= o <= 0x217F or 0x1D400 <= o <= 0x1D7FF or o in (0x2126, 0x212A, 0x212B):
        return unicodedata.normalize("NFKC", ch)
    return ch


_TABLE = {o: plain_char(chr(o)) for r in ((0x00A0, 0x00A1), (0x1680, 0x1681), (0x2000, 0x2064), (0x2126, 0x217F + 1), (0x3000, 0x3001), (0xFB00, 0xFB07), (0xFE63, 0xFE64), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)) for o in range(*r)}
_TABLE = {o: s for o, s in _TABLE.items() if s != chr(o)}
_TABLE |= {ord(c): None for c in map(chr, [*range(0x00AD, 0x00AE), 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x180F), *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF])}
_LOOK_TABLE = str.maketrans(LOOKALIKE)


def plain_word(word: str) -> str:
    """A composed word without ignorables; its look-alikes become Latin where it has Latin letters as well."""
    if _FOREIGN.search(word) and _LATIN.search(word):
        changed = unicodedata.normalize("NFC", word.translate(_LOOK_TABLE))
        return word if _FOREIGN.search(changed) else changed
    return word


def consistent(text: str | None) -> str | None:
    """The consistent form by table; null for null."""
    if text is None or not ODD.search(text):
        return text
    text = unicodedata.normalize("NFC", text.translate(_TABLE))
    return WORD.sub(lambda m: plain_word(m[0]), text) if _FOREIGN.search(text) else text


@F.pandas_udf(StringType())
def _consistent_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(consistent, na_action="ignore")


def consistent_form(text: Column) -> Column:
    """``consistent`` as a Column. Python sees only texts with an odd character; the others stay in the JVM."""
    return F.coalesce(_consistent_udf(F.when(looks_odd(text), text)), text)


def looks_odd(text: Column) -> Column:
    return F.coalesce(text.rlike(HAS_ODD_JAVA), F.lit(False))
