"""Quality rules over the sections of a version and over version messages, with severities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.law_text import strip

BY = ["abbrev", "fassung_vom"]
SEVERITIES = ("INFO", "WARNING", "CRITICAL")
# The form of a date in a message; thresholds below are those of the rules.
DATED = r"\[\d{4}-\d{2}-\d{2}\]"


def duplicates(sections: DataFrame) -> DataFrame:
    """BY, section_id, n of ids that occur more than once in a version."""
    return sections.groupBy(*BY, "section_id").agg(F.count("*").alias("n")).where("n > 1")


def gaps(sections: DataFrame, widest: int = 5, least: int = 5) -> DataFrame:
    """BY, from_no, to_no: more than ``widest`` paragraph numbers apart, in versions with ``least`` paragraphs or more."""
    no = F.regexp_extract("section_id", r"^§_(\d+)[a-z]?$", 1)
    numbered = sections.where(no != "").select(*BY, no.cast("int").alias("from_no"))
    w = Window.partitionBy(*BY)
    numbered = numbered.withColumns({"to_no": F.lead("from_no").over(w.orderBy("from_no")), "n": F.count("*").over(w)})
    return numbered.where((F.col("n") >= least) & (F.col("to_no") - F.col("from_no") > widest)).select(*BY, "from_no", "to_no")


def order_key(sid: Column) -> Column:
    """Ids with a plain number first, by number and prefix; then others with a prefix; then the rest."""
    number = F.when(sid.rlike(r"^[^_]*_\d+$"), F.regexp_extract(sid, r"_(\d+)$", 1).cast("int"))
    return F.struct(F.when(number.isNotNull(), 0).when(sid.contains("_"), 1).otherwise(2).alias("k"), F.coalesce(number, F.lit(0)).alias("n"), F.when(number.isNotNull(), F.substring_index(sid, "_", 1)).otherwise(sid).alias("t"))


def out_of_order(sections: DataFrame) -> DataFrame:
    """BY, n_out_of_order: sections whose place by arrival is not their place in order."""
    w = Window.partitionBy(*BY)
    placed = sections.select(*BY, "section_id", F.row_number().over(w.orderBy("arrival")).alias("at"), F.row_number().over(w.orderBy(order_key(F.col("section_id")), "arrival")).alias("due"))
    expected = placed.select(*BY, F.col("due").alias("at"), F.col("section_id").alias("expected"))
    return placed.join(expected, [*BY, "at"]).where("section_id != expected").groupBy(*BY).agg(F.count("*").alias("n_out_of_order"))


def malformed(sid: Column) -> Column:
    """What is wrong with the form of an id; null if nothing is."""
    # fixed values: the patterns and the words for them
    hidden = sid.startswith("Section-") | (sid == "Text")
    return F.when(~hidden, F.when(sid.rlike("[,;]$"), "trailing punctuation").when(sid.rlike("[._]Paragraph"), "contains Paragraph text").when(sid.rlike(r"\.\s"), "contains spaces/dots"))


def short_body(body: Column, least: int = 20) -> Column:
    """"empty", or the number of characters of a body under ``least``; null for longer ones. Null counts as empty."""
    n = F.length(strip(F.coalesce(body, F.lit(""))))
    return F.when(n == 0, "empty").when(n < least, F.concat(n.cast("string"), F.lit(" chars")))


def valid_id(sid: Column) -> Column:
    """Whether an id has two characters or more, a plain letter or digit among them; false for null."""
    return F.coalesce((F.length(strip(sid)) >= 2) & sid.rlike("[a-zA-Z0-9]"), F.lit(False))


def undated(commits: DataFrame) -> DataFrame:
    """gsn, n_commits, n_undated, flagged (over a tenth of two commits or more) by messages without a date in brackets."""
    bad = ~F.coalesce(F.col("message").rlike(DATED), F.lit(False))
    out = commits.groupBy("gsn").agg(F.count("*").alias("n_commits"), F.count_if(bad).alias("n_undated"))
    return out.withColumn("flagged", (F.col("n_commits") > 1) & (F.col("n_undated") > 0.1 * F.col("n_commits")))


def issues(sections: DataFrame) -> DataFrame:
    """BY, severity, check, n: every rule that a version breaks, with how often."""
    sid = F.col("section_id")
    counted = sections.groupBy(*BY).agg(F.count("*").alias("total"), F.count_if(sid.startswith("Section-")).alias("hashed"), F.count_if(sid == "Text").alias("texts"), F.count(short_body(F.col("body"))).alias("short"), F.count(malformed(sid)).alias("malformed"))
    found = F.array_compact(F.array(
        F.when(F.col("hashed") > 0, F.struct(F.when(F.col("hashed") > 0.1 * F.col("total"), "CRITICAL").otherwise("WARNING").alias("severity"), F.lit("section_n").alias("check"), F.col("hashed").alias("n"))),
        *(F.when(F.col(c) > 0, F.struct(F.lit(s).alias("severity"), F.lit(name).alias("check"), F.col(c).alias("n"))) for c, s, name in (("texts", "WARNING", "text_ids"), ("short", "WARNING", "short_bodies"), ("malformed", "INFO", "malformed_ids"))),
        F.when(F.col("total") < 5, F.struct(F.lit("CRITICAL").alias("severity"), F.lit("too_few_sections").alias("check"), F.col("total").alias("n"))),
    ))
    simple = counted.select(*BY, F.explode(found).alias("i")).select(*BY, "i.*")

    def as_issue(df: DataFrame, severity: str, check: str, n: Column) -> DataFrame:
        return df.groupBy(*BY).agg(n.cast("long").alias("n")).select(*BY, F.lit(severity).alias("severity"), F.lit(check).alias("check"), "n")

    return (
        simple.unionByName(as_issue(gaps(sections), "INFO", "gaps", F.count("*")))
        .unionByName(as_issue(duplicates(sections), "CRITICAL", "duplicates", F.count("*")))
        .unionByName(as_issue(out_of_order(sections), "WARNING", "sort_order", F.max("n_out_of_order")))
    )


def severities(found: DataFrame) -> DataFrame:
    """abbrev, severity: the worst severity of each law."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity")).cast("int")
    return found.groupBy("abbrev").agg(F.max(rank).alias("r")).select("abbrev", F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col("r")).alias("severity"))


def warning_categories(found: DataFrame) -> DataFrame:
    """check, n_laws: the checks of laws whose worst severity is WARNING."""
    mild = severities(found).where("severity = 'WARNING'").select("abbrev")
    return found.where("severity = 'WARNING'").join(mild, "abbrev", "left_semi").groupBy("check").agg(F.countDistinct("abbrev").alias("n_laws"))


def _listed(df: DataFrame, check: str, order: Column, text: Column, most: int) -> DataFrame:
    """BY, check, n and the first ``most`` texts by ``order`` of each version's rows. Only so many are kept while rows are gathered."""
    ranked = df.select(*BY, order.alias("_o"), text.alias("_t")).withColumn("_n", F.count("*").over(Window.partitionBy(*BY))).withColumn("_k", F.row_number().over(Window.partitionBy(*BY).orderBy("_o", "_t")))
    kept = ranked.where(F.col("_k") <= most).groupBy(*BY).agg(F.max("_n").alias("n"), F.array_sort(F.collect_list(F.struct("_k", "_t"))).alias("l"))
    return kept.select(*BY, F.lit(check).alias("check"), "n", F.transform("l", lambda x: x["_t"]).alias("listed"))


def details(sections: DataFrame) -> DataFrame:
    """BY, check, n, listed: what breaks each rule in words, the first five (three for the order) in order of arrival."""
    sid = F.col("section_id")
    short, wrong = short_body(F.col("body")), malformed(sid)
    pairs = lambda text: F.concat(sid, F.lit(": "), text)
    w = Window.partitionBy(*BY)
    placed = sections.select(*BY, "section_id", F.row_number().over(w.orderBy("arrival")).alias("at"), F.row_number().over(w.orderBy(order_key(sid), "arrival")).alias("due"))
    expected = placed.select(*BY, F.col("due").alias("at"), sid.alias("expected"))
    out_of_place = placed.join(expected, [*BY, "at"]).where("section_id != expected")
    order_text = F.concat(F.lit("pos "), (F.col("at") - 1).cast("string"), F.lit(": "), sid, F.lit(" should be "), F.col("expected"))
    gap_text = F.concat(F.lit("§ "), F.col("from_no").cast("string"), F.lit(" → § "), F.col("to_no").cast("string"), F.lit(" (gap of "), (F.col("to_no") - F.col("from_no")).cast("string"), F.lit(")"))
    twice = sections.groupBy(*BY, "section_id").agg(F.count("*").alias("times"), F.min("arrival").alias("arrival")).where("times > 1")
    return (
        _listed(sections.where(short.isNotNull()), "short_bodies", F.col("arrival"), pairs(short), 5)
        .unionByName(_listed(sections.where(wrong.isNotNull()), "malformed_ids", F.col("arrival"), pairs(wrong), 5))
        .unionByName(_listed(gaps(sections), "gaps", F.col("from_no"), gap_text, 5))
        .unionByName(_listed(twice, "duplicates", F.col("arrival"), sid, 5))
        .unionByName(_listed(out_of_place, "sort_order", F.col("at"), order_text, 3))
    )


def law_issues(sections: DataFrame, commits: DataFrame, diffs: DataFrame) -> DataFrame:
    """abbrev, severity, check, n: rules on a law as a whole.

    ``commits``: gsn, fassung_vom, message, committed_at. ``diffs``: abbrev, section_id, old_body, new_body,
    change_kind between a law's first and last version. Rules: api_error (committed, but no sections at all),
    git_error (sections, but never committed), missing_fassung and empty_fassung (no sections, or none with a body, at
    the last committed date), StF_empty and latest_empty (none at the first or last committed date), commit_messages,
    empty_diff (nothing to compare), diff_empty_body and diff_section_n (among the first three changed sections).
    """
    rows = sections.where("abbrev is not null and fassung_vom is not null")
    per = rows.groupBy(*BY).agg(F.count("*").alias("rows"), F.count_if(strip(F.coalesce("body", F.lit(""))) != "").alias("filled"))
    dated = commits.where("gsn is not null").groupBy(F.col("gsn").alias("abbrev")).agg(F.min("fassung_vom").alias("first"), F.max("fassung_vom").alias("last"))
    laws = per.groupBy("abbrev").agg(F.sum("rows").alias("rows"), F.count("*").alias("versions"))
    at = lambda which: per.select("abbrev", F.col("fassung_vom").alias(which), F.col("rows").alias(f"{which}_rows"), F.col("filled").alias(f"{which}_filled"))
    known = dated.withColumn("committed", F.lit(True)).join(laws, "abbrev", "full_outer").join(at("first"), ["abbrev", "first"], "left").join(at("last"), ["abbrev", "last"], "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    has = F.col("committed") & F.col("rows").isNotNull()
    one = lambda when, severity, check: F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(check).alias("check"), F.lit(1).cast("long").alias("n")))
    found = F.array_compact(F.array(
        one(F.col("committed") & F.col("rows").isNull(), "CRITICAL", "api_error"),
        one(F.col("committed").isNull(), "CRITICAL", "git_error"),
        one(has & none("last_rows"), "CRITICAL", "missing_fassung"),
        one(has & ~none("last_rows") & none("last_filled"), "CRITICAL", "empty_fassung"),
        one(has & none("first_rows"), "CRITICAL", "StF_empty"),
        one(has & none("last_rows") & (F.col("first") != F.col("last")), "CRITICAL", "latest_empty"),
    ))
    simple = known.select("abbrev", F.explode(found).alias("i")).select("abbrev", "i.*")
    messages = undated(commits.where("gsn is not null")).where("flagged").select(F.col("gsn").alias("abbrev"), F.lit("WARNING").alias("severity"), F.lit("commit_messages").alias("check"), F.col("n_undated").alias("n"))
    compared = diffs.groupBy("abbrev").agg(F.count("*").alias("compared"))
    nothing = laws.where("versions > 1").join(compared, "abbrev", "left").where("compared is null").select("abbrev", F.lit("WARNING").alias("severity"), F.lit("empty_diff").alias("check"), F.lit(1).cast("long").alias("n"))
    place = F.row_number().over(Window.partitionBy("abbrev").orderBy("section_id"))
    spot = diffs.where("change_kind != 'unchanged'").withColumn("_k", place).where("_k <= 3")
    blank = (F.coalesce("old_body", F.lit("")) == "") & (F.coalesce("new_body", F.lit("")) == "")
    spots = spot.groupBy("abbrev").agg(F.count_if(blank).alias("diff_empty_body"), F.count_if(F.col("section_id").startswith("Section-")).alias("diff_section_n"))
    spots = spots.unpivot("abbrev", ["diff_empty_body", "diff_section_n"], "check", "n").where("n > 0").select("abbrev", F.lit("WARNING").alias("severity"), "check", "n")
    return simple.unionByName(messages).unionByName(nothing).unionByName(spots)


def histogram(found: DataFrame, laws: DataFrame) -> DataFrame:
    """severity, n_laws: how many laws have each worst severity; OK for laws without an issue."""
    worst = laws.select("abbrev").distinct().join(severities(found), "abbrev", "left")
    return worst.groupBy(F.coalesce("severity", F.lit("OK")).alias("severity")).agg(F.count("*").alias("n_laws"))


def kind_counts(sections: DataFrame) -> DataFrame:
    """BY, total, proper, percent_proper, hashed, paragraphs, articles, annexes, mixed of each version."""
    sid = F.col("section_id")
    kinds = {"paragraphs": "§_", "articles": "Art_", "annexes": "Anlage_"}
    out = sections.groupBy(*BY).agg(F.count("*").alias("total"), F.count_if(~sid.startswith("Section-")).alias("proper"), F.count_if(sid.startswith("Section-")).alias("hashed"), *(F.count_if(sid.startswith(p)).alias(k) for k, p in kinds.items()))
    several = sum(((F.col(k) > 0).cast("int") for k in kinds), F.lit(0)) > 1
    return out.withColumns({"percent_proper": 100 * F.col("proper") / F.col("total"), "mixed": several})


def first_violations(sections: DataFrame) -> DataFrame:
    """BY, prefix, position, expected, actual, kind: the first section of each kind that is not in its place by number.

    kind is reorder where the expected section stands elsewhere in the version, else missing.
    """
    sid = F.col("section_id")
    prefix = F.regexp_extract(sid, "^(§|Art|Anlage)_", 1)
    no = F.regexp_extract(sid, r"^(?:§|Art|Anlage)_(\d+)", 1)
    key = F.struct(F.coalesce(F.nullif(no, F.lit("")).cast("int"), F.lit(999999)).alias("n"), F.when(no == "", sid).otherwise(F.regexp_extract(sid, r"^(?:§|Art|Anlage)_\d+([a-z]?)", 1)).alias("s"))
    w = Window.partitionBy(*BY, "prefix")
    placed = sections.withColumn("prefix", prefix).where("prefix != ''").select(*BY, "prefix", "section_id", F.row_number().over(w.orderBy("arrival")).alias("position"), F.row_number().over(w.orderBy(key, "arrival")).alias("due"))
    expected = placed.select(*BY, "prefix", F.col("due").alias("position"), F.col("section_id").alias("expected"))
    wrong = placed.join(expected, [*BY, "prefix", "position"]).where("section_id != expected")
    first = wrong.groupBy(*BY, "prefix").agg(F.min_by(F.struct("position", "expected", F.col("section_id").alias("actual")), "position").alias("f"))
    there = placed.select(*BY, "prefix", F.col("section_id").alias("expected"), F.lit("reorder").alias("kind")).distinct()
    return first.select(*BY, "prefix", "f.*").join(there, [*BY, "prefix", "expected"], "left").fillna("missing", ["kind"]).select(*BY, "prefix", "position", "expected", "actual", "kind")
