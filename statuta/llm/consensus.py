"""One surviving record of each group of duplicates, by token-level consensus.

The different texts of a group are aligned progressively, vote for their tokens by weight, and are scored by their
distance to the consensus (``operators.duplicates``, which histories and snapshot differences share). The value closest
to the consensus survives; it is always an existing value. Ties go to the lowest source rank, then the latest load.
The heading is the surviving row's if it is usable, else the best ranked usable one.

Hashes find the groups whose texts differ; groups of one text never reach Python. Null and blank texts take part as
texts without tokens. Groups of one row give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.charforms import consistent_form
from ..functions.integrity import BROKEN
from ..operators.duplicates import KEY, best, with_damage


def usable_heading(heading: Column) -> Column:
    """Whether a heading (in consistent form) says what its section is about and has its characters intact."""
    h = F.btrim(heading)
    # fixed values: fillers that stand for a missing heading
    filler = h.rlike(r"(?i)^(\(?\s*anm\b.*|\[.*\]|text|titel|überschrift|k\.\s*a\.|n\.\s*v\.|keine angabe|ohne (titel|überschrift)|unbekannt|null|none|n/a|siehe\b.*)$")
    return F.coalesce(h.rlike(r"\p{L}{3,}") & ~filler & ~h.rlike(BROKEN.pattern), F.lit(False))


def survivors(fassung: DataFrame, quellen: DataFrame) -> DataFrame:
    """body_rec_id, heading_rec_id and the key of every key with two rows or more."""
    rows = with_damage(fassung, quellen, usable_heading(consistent_form(F.col("heading"))).alias("usable"))
    groups = rows.groupBy(*KEY).agg(
        F.count("*").alias("n"),
        F.min_by(F.struct("rec_id", "usable"), best(["damage"])).alias("body"),
        F.min_by(F.when(F.col("usable"), F.col("rec_id")), F.when(F.col("usable"), best())).alias("titled"),
    )
    heading = F.when(F.col("body.usable"), F.col("body.rec_id")).otherwise(F.coalesce("titled", "body.rec_id"))
    return groups.where("n > 1").select(*KEY, F.col("body.rec_id").alias("body_rec_id"), heading.alias("heading_rec_id"))
