"""The version model: snapshots of sections, versions, reconstruction as of a version, changes between versions.

Section rows have abbrev, fassung_vom, section_id, heading, body, arrival (unique; orders rows of one key). A version
is a law at a date; seq counts a law's versions from 1. Nulls in abbrev, fassung_vom or section_id leave a row out;
null bodies count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.law_text import extract_id_from_body, norm_section_id, section_sort_key

VERSION = ["abbrev", "fassung_vom"]
# thresholds of the reconstruction: a version with FULL sections stands alone; one with ENOUGH of them, less than
# OVERLAP of which are known from the first version, stands alone as well
FULL, ENOUGH, OVERLAP = 30, 5, 0.4
#: Slices of a law's sections in joins by law.
SLICES = 16


def build_snapshot(rows: DataFrame) -> DataFrame:
    """One row a version and section: the longest non-empty body, the earliest arrival among equals."""
    rows = rows.where(F.col("abbrev").isNotNull() & F.col("fassung_vom").isNotNull() & F.col("section_id").isNotNull() & (F.col("body") != ""))
    kept = rows.groupBy(*VERSION, "section_id").agg(F.max_by(F.struct("heading", "body", "section_type", "arrival"), F.struct(F.length("body"), -F.col("arrival"))).alias("s"))
    return kept.select(*VERSION, "section_id", "s.*")


def versions_of(rows: DataFrame) -> DataFrame:
    """abbrev, fassung_vom, seq of each version of a snapshot or of section rows with a body; only the keys are moved."""
    if "body" in rows.columns:
        rows = rows.where(F.col("abbrev").isNotNull() & F.col("fassung_vom").isNotNull() & F.col("section_id").isNotNull() & (F.col("body") != ""))
    return rows.select(*VERSION).distinct().withColumn("seq", F.row_number().over(Window.partitionBy("abbrev").orderBy("fassung_vom")))


def with_seq(snapshot: DataFrame, versions: DataFrame) -> DataFrame:
    return snapshot.join(versions, VERSION)


def short_id(column: str | Column) -> Column:
    """The first eight characters of a version's id."""
    return F.left(F.col(column) if isinstance(column, str) else column, F.lit(8))


def author_date(fassung_vom: Column) -> Column:
    """The date a version is filed under; null for dates outside of what a version store can hold."""
    # fixed values: the first date and the one after the last
    return F.when((fassung_vom >= "1970-01-01") & (fassung_vom < "2100-01-01"), fassung_vom)


def group_by_date_first(commits: DataFrame) -> DataFrame:
    """The first commit of each law and date: gsn, fassung_vom, version_id, aenderung."""
    return commits.groupBy("gsn", "fassung_vom").agg(F.min_by(F.struct("version_id", "aenderung"), "version_id").alias("f")).select("gsn", "fassung_vom", "f.*")


def resolve_version(commits: DataFrame) -> DataFrame:
    """The newest commit of each law and date: gsn, fassung_vom, version_id."""
    order = F.struct("committed_at", "version_id")
    return commits.groupBy("gsn", "fassung_vom").agg(F.max_by("version_id", order).alias("version_id"))


def newest_effective(versions: DataFrame, today: str) -> DataFrame:
    """abbrev, fassung_vom of the latest version up to ``today``, else of the latest one."""
    return versions.groupBy("abbrev").agg(F.coalesce(F.max(F.when(F.col("fassung_vom") <= today, F.col("fassung_vom"))), F.max("fassung_vom")).alias("fassung_vom"))


def is_proper(sid: Column) -> Column:
    return ~(sid.startswith("Section-") | (sid == "Text"))


def normalize_sections(rows: DataFrame) -> DataFrame:
    """Section rows (with seq) under normalised ids, the longest body where ids meet.

    Ids by hash and unnamed texts take an id from their body if it names one. Of a version with nothing but unnamed
    texts, those over 100 characters come back under numbered ids.
    """
    raw = F.col("section_id")
    found = extract_id_from_body(F.col("body"))
    named = norm_section_id(raw)
    sid = F.when(raw == "Text", F.lit(None)).when(named.startswith("Section-"), F.coalesce(found, named)).otherwise(named)
    keyed = rows.withColumn("sid", sid).withColumn("n", F.max(F.when(F.col("sid").isNotNull(), 1).otherwise(0)).over(Window.partitionBy(*VERSION)))
    spare = F.row_number().over(Window.partitionBy(*VERSION).orderBy("arrival"))
    back = keyed.where("n = 0 and length(body) > 100").withColumn("sid", F.coalesce(found, F.concat(F.lit("Section-"), spare.cast("string"))))
    keyed = keyed.where("sid is not null").unionByName(back)
    kept = keyed.groupBy(*VERSION, "seq", "sid").agg(F.max_by(F.struct("heading", "body", "section_type", "arrival"), F.struct(F.length("body"), -F.col("arrival"))).alias("s"))
    return kept.select(*VERSION, "seq", F.col("sid").alias("section_id"), "s.*")


def overlay_rules(sections: DataFrame) -> DataFrame:
    """abbrev, fassung_vom, seq, rule, drop_first of every version.

    rule: ``own`` (the version stands alone), ``first`` (the first version stands for it) or ``overlay`` (the last
    write of each section up to it; without what only the first version has if ``drop_first``).
    """
    proper, hashed = is_proper(F.col("section_id")), F.col("section_id").startswith("Section-")
    first = sections.where("seq = 1").select("abbrev", "section_id", F.lit(1).alias("known")).where(proper)
    counted = sections.join(first, ["abbrev", "section_id"], "left").groupBy(*VERSION, "seq").agg(
        F.count("*").alias("total"), F.count_if(proper).alias("proper"), F.count_if(hashed).alias("hashed"), F.count("known").alias("common")
    )
    w = Window.partitionBy("abbrev").orderBy("seq")
    counted = counted.withColumns({f"{c}_1": F.first(c).over(w) for c in ("total", "proper", "hashed")})
    fuller = (F.col("seq") > 1) & (F.col("proper") > 1.3 * F.col("proper_1")) & (F.col("proper") >= 10)
    counted = counted.withColumn("fuller", F.max(fuller).over(w))
    poor_first = (F.col("proper_1") < 20) | (F.col("hashed_1") / F.greatest(F.col("total_1"), F.lit(1)) > 0.4)
    alone = (F.col("proper") >= ENOUGH) & (F.col("common") < OVERLAP * F.col("proper"))
    rule = (
        F.when((F.col("seq") == 1) | (F.col("proper") >= FULL), "own")
        .when(alone, F.when((F.col("hashed_1") > 0.2 * F.col("total_1")) & (F.col("total_1") > F.col("total")), "first").otherwise("own"))
        .otherwise("overlay")
    )
    return counted.select(*VERSION, "seq", rule.alias("rule"), ((rule == "overlay") & poor_first & F.col("fuller")).alias("drop_first"))


def by_law(rows: DataFrame, small: DataFrame) -> DataFrame:
    """``rows`` (with section_id) joined by abbrev with a table of few rows a law, which is repeated for slices of a law's sections.

    So a law that holds a large part of all rows is joined in many tasks.
    """
    slices = small.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return rows.withColumn("_slice", F.pmod(F.xxhash64("section_id"), F.lit(SLICES)).cast("int")).join(slices, ["abbrev", "_slice"]).drop("_slice")


def as_of_all(sections: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The reconstructed sections of every version (or those in ``targets``: abbrev, seq).

    abbrev, fassung_vom, seq, section_id, heading, body, written_seq (the version that wrote the section). Each
    section's writes become intervals of versions; an interval gives a row for each version in it, and these meet the
    versions' rules by law and version.
    """
    rules = overlay_rules(sections)
    if targets is not None:
        rules = rules.join(targets.select("abbrev", "seq"), ["abbrev", "seq"], "left_semi").select(*VERSION, "seq", "rule", "drop_first")
    cols = ["section_id", "heading", "body"]
    own = rules.where("rule = 'own'").join(sections.select("abbrev", "seq", *cols), ["abbrev", "seq"]).select(*VERSION, "seq", *cols, F.col("seq").alias("written_seq"))
    first = by_law(sections.where("seq = 1").select("abbrev", *cols), rules.where("rule = 'first'").select(*VERSION, "seq")).select(*VERSION, "seq", *cols, F.lit(1).alias("written_seq"))
    spans = sections.select("abbrev", F.col("seq").alias("written_seq"), *cols, F.lead("seq").over(Window.partitionBy("abbrev", "section_id").orderBy("seq")).alias("until"))
    wanted = rules.where("rule = 'overlay'")
    if targets is None:
        last = wanted.groupBy("abbrev").agg(F.max("seq").alias("_last"))
        inside = F.sequence("written_seq", F.coalesce(F.col("until") - 1, F.greatest("_last", "written_seq")))
        held = by_law(spans, last)
    else:  # few versions a law
        asked = wanted.groupBy("abbrev").agg(F.collect_list("seq").alias("_asked"))
        inside = F.filter("_asked", lambda x: (x >= F.col("written_seq")) & (F.col("until").isNull() | (x < F.col("until"))))
        held = by_law(spans, asked)
    held = held.select("abbrev", *cols, "written_seq", F.explode(inside).alias("seq"))
    overlay = held.join(wanted.select(*VERSION, "seq", "drop_first"), ["abbrev", "seq"]).where("not (drop_first and written_seq = 1)")
    return own.unionByName(first).unionByName(overlay.select(*VERSION, "seq", *cols, "written_seq"))


def changed_sections(sections: DataFrame) -> DataFrame:
    """abbrev, fassung_vom, section_id, change_kind (added, removed, modified) of each version after a law's first.

    One grouped pass: every section row counts for its own version and, as the old state, for the next one.
    """
    dates = versions_of(sections).withColumn("next_date", F.lead("fassung_vom").over(Window.partitionBy("abbrev").orderBy("seq")))
    dates = dates.withColumn("first", F.col("seq") == 1)
    rows = sections.select(*VERSION, "section_id", F.coalesce("body", F.lit("")).alias("body")).join(dates, VERSION)
    now = rows.where("not first").select(*VERSION, "section_id", F.col("body").alias("new"), F.lit(None).cast("string").alias("old"))
    before = rows.where("next_date is not null").select("abbrev", F.col("next_date").alias("fassung_vom"), "section_id", F.lit(None).cast("string").alias("new"), F.col("body").alias("old"))
    pairs = now.unionByName(before).groupBy(*VERSION, "section_id").agg(F.max("new").alias("new"), F.max("old").alias("old"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("modified")
    return pairs.where("not (new <=> old)").select(*VERSION, "section_id", kind.alias("change_kind"))


def changed_lists(sections: DataFrame) -> DataFrame:
    """abbrev, fassung_vom, changed (ids in natural order) of every version; the first one's list is empty."""
    ids = changed_sections(sections).groupBy(*VERSION).agg(F.array_sort(F.collect_list(F.struct(section_sort_key(F.col("section_id")).alias("k"), "section_id"))).alias("l"))
    out = versions_of(sections).join(ids, VERSION, "left")
    return out.select(*VERSION, F.coalesce(F.transform("l", lambda x: x["section_id"]), F.array().cast("array<string>")).alias("changed"))
