"""Differences between two versions of a law, and their renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.law_text import display_heading, paragraphs, strip_section_prefix


def diff_sections(old: DataFrame, new: DataFrame, by: list[str], section_id: str | None = None, section_type: str | None = None) -> DataFrame:
    """by, section_id, heading, old_body, new_body, change_kind for the sections of either side.

    A missing section and an empty body are the same. The heading is the new side's if it has the section, else the
    old side's, else the id. ``section_type`` keeps sections that have this type on either side.
    """
    o = old.select(*by, "section_id", F.col("heading").alias("old_heading"), F.col("body").alias("old_body"), F.col("section_type").alias("old_type"), F.lit(True).alias("in_old"))
    n = new.select(*by, "section_id", F.col("heading").alias("new_heading"), F.col("body").alias("new_body"), F.col("section_type").alias("new_type"), F.lit(True).alias("in_new"))
    # filters go below the join, which could not pass them down itself
    if section_id is not None:
        o, n = (x.where(F.col("section_id") == section_id) for x in (o, n))
    if section_type is not None:
        ids = o.where(F.col("old_type") == section_type).select(*by, "section_id").union(n.where(F.col("new_type") == section_type).select(*by, "section_id")).distinct()
        o, n = (x.join(ids, [*by, "section_id"], "left_semi") for x in (o, n))
    both = o.join(n, [*by, "section_id"], "full_outer")
    before, after = (F.coalesce(c, F.lit("")) for c in ("old_body", "new_body"))
    kind = F.when(before == after, "unchanged").when(before == "", "added").when(after == "", "removed").otherwise("changed")
    heading = F.when(F.col("in_new"), F.coalesce("new_heading", F.lit(""))).otherwise(F.coalesce("old_heading", "section_id"))
    return both.select(*by, "section_id", heading.alias("heading"), "old_body", "new_body", kind.alias("change_kind"))


def diff_as_shown(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """The same over reconstructed sections, with display headings and bodies without their numbers (null if empty)."""
    typed = [x.withColumn("section_type", F.lit(None).cast("string")) for x in (old, new)]
    d = typed[0].select(*by, "section_id", F.col("heading").alias("oh"), F.col("body").alias("ob")).join(typed[1].select(*by, "section_id", F.col("heading").alias("nh"), F.col("body").alias("nb")), [*by, "section_id"], "full_outer")
    before, after = (F.coalesce(c, F.lit("")) for c in ("ob", "nb"))
    same = before == after
    fallback = F.when(same, F.lit(None).cast("string")).otherwise(F.nullif("oh", F.lit("")))
    heading = F.coalesce(F.nullif("nh", F.lit("")), fallback, F.lit(""))

    def shown(body: Column) -> Column:
        return F.when(~same & (body != ""), strip_section_prefix(body))

    kind = F.when(same, "unchanged").when(before == "", "added").when(after == "", "removed").otherwise("changed")
    return d.select(*by, "section_id", display_heading(F.col("section_id"), heading).alias("heading"), shown(before).alias("old_body"), shown(after).alias("new_body"), kind.alias("change_kind"))


def diff_summary(diff: DataFrame, by: list[str]) -> DataFrame:
    """by, changed_count, unchanged_count, total_sections."""
    same = F.count_if(F.col("change_kind") == "unchanged")
    return diff.groupBy(*by).agg((F.count("*") - same).alias("changed_count"), same.alias("unchanged_count"), F.count("*").alias("total_sections"))


def diff_json(diff: DataFrame, by: list[str]) -> DataFrame:
    """by, json: the changed sections of a difference as one JSON array, ordered by id."""
    entry = F.struct("section_id", "heading", "old_body", "new_body")
    return diff.where("change_kind != 'unchanged'").groupBy(*by).agg(F.to_json(F.array_sort(F.collect_list(entry)), {"ignoreNullFields": "false"}).alias("json"))


def diff_plain_lines(diff: DataFrame, by: list[str]) -> DataFrame:
    """by, text: a heading line a changed section, then its old and new body, ordered by id."""
    lines = F.concat_ws("\n", F.concat(F.lit("── "), F.col("heading"), F.lit(" ──")), F.when(F.coalesce("old_body", F.lit("")) != "", F.concat(F.lit("- "), "old_body")), F.when(F.coalesce("new_body", F.lit("")) != "", F.concat(F.lit("+ "), "new_body")))
    rows = diff.where("change_kind != 'unchanged'").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("section_id", lines.alias("t")))).alias("l"))
    return rows.select(*by, F.array_join(F.transform("l", lambda x: x["t"]), "\n\n").alias("text"))


def paragraph_counts(diff: DataFrame, by: list[str]) -> DataFrame:
    """by, sections, insertions, deletions: paragraphs of one side that the other lacks, repeated ones counted each."""
    o, n = paragraphs(F.col("old_body")), paragraphs(F.col("new_body"))
    added = F.size(F.filter(n, lambda x: ~F.array_contains(o, x)))
    gone = F.size(F.filter(o, lambda x: ~F.array_contains(n, x)))
    return diff.where("change_kind != 'unchanged'").groupBy(*by).agg(F.count("*").alias("sections"), F.sum(added).alias("insertions"), F.sum(gone).alias("deletions"))
