"""Regular section ids as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charforms import HYPHENS, SPACES

_GONE = "\u00ad\u034f\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"


def regular_id(section_id: Column) -> Column:
    """``§_5a``, ``Art_3``, ``Art_II``, ``Art_II_§_4``, ``Anlage_2`` or ``Section-77`` for any spelling of such an id.

    An id that names none of these comes back trimmed; a null or blank id gives null.
    """
    s = F.btrim(F.translate(section_id, SPACES + HYPHENS + _GONE, " " * len(SPACES) + "-" * len(HYPHENS)))
    digits = "(\\d+[a-zA-Z]?)(?![a-zA-Z])"
    article = F.regexp_extract(s, f"(?i)(?:^|[^a-z])art(?:ikel)?[._ ]*(?:{digits}|([ivxlcdm]+)(?![a-z]))", 1)
    roman = F.upper(F.regexp_extract(s, f"(?i)(?:^|[^a-z])art(?:ikel)?[._ ]*(?:{digits}|([ivxlcdm]+)(?![a-z]))", 2))
    article = F.when(article != "", F.lower(article)).otherwise(roman)
    paragraph = F.lower(F.regexp_extract(s, f"§+[._ ]*{digits}", 1))
    annex = F.lower(F.regexp_extract(s, f"(?i)(?:^|[^a-z])anlage[._ ]*{digits}", 1))
    hashed = F.regexp_extract(s, "(?i)^section[-_ ]*(\\d+)", 1)
    return (
        # most ids are regular already
        F.when(section_id.rlike(r"^(?:§|Art|Anlage)_[0-9]+[a-z]?$"), section_id)
        .when(s.isNull() | (s == ""), F.lit(None).cast("string"))
        .when(hashed != "", F.concat(F.lit("Section-"), hashed))
        .when((article != "") & (paragraph != ""), F.concat(F.lit("Art_"), article, F.lit("_§_"), paragraph))
        .when(article != "", F.concat(F.lit("Art_"), article))
        .when(paragraph != "", F.concat(F.lit("§_"), paragraph))
        .when(annex != "", F.concat(F.lit("Anlage_"), annex))
        .otherwise(s)
    )
