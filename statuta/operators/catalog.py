"""Catalogs: lookups of names, the matching cascade over index entries, disambiguation, the final list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.law_text import clean_law_name, extract_year, jaccard_words, normalize_name, strip
from ..functions.sequences import matching_ratio
from ..sources.stored import stored

#: Characters by which an abbreviation is found in those that contain it.
GRAM = 3
#: A word in more than this share of the names is a common word.
COMMON = 0.01


def deduplicated(catalog: DataFrame) -> DataFrame:
    """One row a gsn, of the latest scan (the greatest cat_id): gsn, name, abbrev, typ. Null gsn are left out."""
    kept = catalog.where("gsn is not null").groupBy("gsn").agg(F.max_by(F.struct("name", "abbrev", "typ"), "cat_id").alias("c"))
    return kept.select("gsn", "c.*")


def deduplicated_by_page(catalog: DataFrame, page: Column) -> DataFrame:
    """One row a gsn as a crawl by pages keeps it: of the last page that has it, the first row. gsn, name, abbrev, typ."""
    kept = catalog.where("gsn is not null").groupBy("gsn").agg(F.max_by(F.struct("name", "abbrev", "typ"), F.struct(page.alias("page"), -F.col("cat_id"))).alias("c"))
    return kept.select("gsn", "c.*")


def first_gsn_of_abbrev(catalog: DataFrame) -> DataFrame:
    """abbrev, gsn: of laws with one abbreviation the first scanned. Null and empty abbreviations are left out."""
    return catalog.where("abbrev != ''").groupBy("abbrev").agg(F.min_by("gsn", "cat_id").alias("gsn"))


def law_names(laws: DataFrame, catalog: DataFrame) -> DataFrame:
    """gsn, name of the laws by gsn; laws the catalog lacks have a null name."""
    return laws.join(deduplicated(catalog).select("gsn", clean_law_name(F.col("name")).alias("name")), "gsn", "left").select("gsn", "name")


def law_names_fallback(laws: DataFrame, catalog: DataFrame) -> DataFrame:
    """gsn, abbrev, name by gsn, else by the abbreviation (the first scanned law of it), else empty."""
    by_gsn = deduplicated(catalog).select("gsn", F.nullif(clean_law_name(F.col("name")), F.lit("")).alias("n1"))
    by_abbrev = catalog.where("abbrev != ''").groupBy("abbrev").agg(F.min_by("name", "cat_id").alias("n"))
    by_abbrev = by_abbrev.select("abbrev", F.nullif(clean_law_name(F.col("n")), F.lit("")).alias("n2"))
    return laws.join(by_gsn, "gsn", "left").join(by_abbrev, "abbrev", "left").select("gsn", "abbrev", F.coalesce("n1", "n2", F.lit("")).alias("name"))


def _entry(entries: DataFrame) -> DataFrame:
    return entries.select("entry_id", strip(F.coalesce("index_name", F.lit(""))).alias("index_name"), strip(F.coalesce("index_abbrev", F.lit(""))).alias("index_abbrev"))


def _law(catalog: DataFrame) -> DataFrame:
    c = deduplicated(catalog)
    return c.select("gsn", F.coalesce("name", F.lit("")).alias("name"), strip(F.coalesce("abbrev", F.lit(""))).alias("abbrev"), F.coalesce("typ", F.lit("")).alias("typ"))


def match_exact(entries: DataFrame, catalog: DataFrame) -> DataFrame:
    """entry_id, gsn, score 1.0 for equal abbreviations, case aside; empty ones match nothing."""
    e = _entry(entries).select("entry_id", F.lower("index_abbrev").alias("k")).where("k != ''")
    return e.join(_law(catalog).select("gsn", F.lower("abbrev").alias("k")), "k").select("entry_id", "gsn", F.lit(1.0).alias("score"))


def match_normalized(entries: DataFrame, catalog: DataFrame) -> DataFrame:
    """entry_id, gsn, score 0.95 for abbreviations equal without years and punctuation."""
    e = _entry(entries).select("entry_id", normalize_name(F.col("index_abbrev")).alias("k")).where("k != ''")
    return e.join(_law(catalog).select("gsn", normalize_name(F.col("abbrev")).alias("k")), "k").select("entry_id", "gsn", F.lit(0.95).alias("score"))


def _grams(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text."""
    return F.array_distinct(F.transform(F.when(F.length(text) >= n, F.sequence(F.lit(0), F.length(text) - n)).otherwise(F.array().cast("array<int>")), lambda i: F.substr(text, i + 1, F.lit(n))))


def match_containment(entries: DataFrame, catalog: DataFrame) -> DataFrame:
    """entry_id, gsn, score 0.85 where one normalised abbreviation contains the other.

    An equi-join: a text is found by its first ``GRAM`` characters (all of a shorter one), which are among the runs of
    as many characters of the text that contains it; so a text has keys in proportion to its length.
    """
    e = _entry(entries).select("entry_id", normalize_name(F.col("index_abbrev")).alias("a")).where("a != ''")
    c = _law(catalog).select("gsn", normalize_name(F.col("abbrev")).alias("b")).where("b != ''")

    def starts(text: str) -> Column:
        return F.left(text, F.lit(GRAM)).alias("key")

    def runs(text: str) -> Column:
        return F.explode(F.concat(*(_grams(F.col(text), n) for n in range(1, GRAM + 1)))).alias("key")

    longer = e.select("*", starts("a")).join(c.select("*", runs("b")), "key").where(F.col("b").contains(F.col("a")))
    shorter = e.select("*", runs("a")).join(c.select("*", starts("b")), "key").where(F.col("a").contains(F.col("b")))
    return longer.select("entry_id", "gsn").unionByName(shorter.select("entry_id", "gsn")).distinct().withColumn("score", F.lit(0.85))


def common_words(names: DataFrame, name: str, share: float = COMMON) -> list[str]:
    """The words in more than ``share`` of the names; at most words-per-name / share of them."""
    words = names.select(F.explode(F.array_distinct(F.split(name, " "))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    total = names.agg(F.count("*").alias("total"))
    return sorted(r.w for r in words.crossJoin(F.broadcast(total)).where(F.col("n") > share * F.col("total")).select("w").collect())  # total is one row


def blocked_pairs(entries: DataFrame, catalog: DataFrame, least: float = 0.0) -> DataFrame:
    """entry_id, gsn, a, b: pairs of normalised names where one of the entry's first two words begins the other.

    With ``least`` only pairs that may have so large a share of common words: two sets of words with that share have a
    word in common among the first of each in any order (all but as many as they must share), so these words are part
    of the key. The order puts common words last, so that a first word that many names have does not make the block.
    """
    e = _entry(entries).select("entry_id", normalize_name(F.col("index_name")).alias("a")).where("a != ''")
    c = _law(catalog).select("gsn", normalize_name(F.col("name")).alias("b")).where("b != ''")
    firsts, first = F.array_distinct(F.slice(F.split("a", " "), 1, 2)), F.substring_index("b", " ", 1)
    if least > 0:
        common = F.array(*map(F.lit, common_words(c, "b"))).cast("array<string>")

        def leading(text: str) -> Column:
            words = F.array_distinct(F.split(text, " "))
            order = F.array_sort(F.transform(words, lambda w: F.struct(F.array_contains(common, w).alias("c"), F.xxhash64(w).alias("h"), w.alias("w"))))
            return F.transform(F.slice(order, F.lit(1), (F.size(words) - F.ceil(F.size(words) * least - 1e-9) + 1).cast("int")), lambda x: x["w"])

        e, c = e.withColumn("p", F.explode(leading("a"))), c.withColumn("p", F.explode(leading("b")))
    e, c = e.withColumn("w", F.explode(firsts)), c.withColumn("w", first)
    return e.join(c, ["w", *(["p"] if least > 0 else [])]).select("entry_id", "gsn", "a", "b").distinct()


def match_words(entries: DataFrame, catalog: DataFrame, min_score: float = 0.2) -> DataFrame:
    """entry_id, gsn, score: blocked pairs by common words alone, the best of each entry and those within 0.02 of it."""
    return _best(blocked_pairs(entries, catalog, min_score).withColumn("score", jaccard_words(F.col("a"), F.col("b"))), min_score)


def _best(pairs: DataFrame, min_score: float) -> DataFrame:
    top = F.max("score").over(Window.partitionBy("entry_id"))
    return pairs.where(F.col("score") >= min_score).withColumn("top", top).where("score >= top - 0.02").select("entry_id", "gsn", "score")


def match_blocked_fuzzy(entries: DataFrame, catalog: DataFrame, min_score: float = 0.6) -> DataFrame:
    """entry_id, gsn, score: six parts common words, four parts matching characters."""
    # characters add 0.4 at most: pairs whose common words can't make up for the rest never reach Python
    least = max(0.0, (min_score - 0.4) / 0.6)
    p = blocked_pairs(entries, catalog, least).withColumn("words", jaccard_words(F.col("a"), F.col("b"))).where(F.col("words") >= least - 1e-9)
    p = p.withColumn("ratio", matching_ratio("a", "b"))
    score = F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.6 * F.col("words") + 0.4 * F.col("ratio"))
    return _best(p.withColumn("score", score), min_score)


def match_cascade(entries: DataFrame, catalog: DataFrame, min_score: float = 0.6) -> DataFrame:
    """entry_id, gsn, score, status (matched, ambiguous, unmatched) by the first step that finds anything."""
    left, found = entries, None
    for step in (match_exact, match_normalized, match_containment, lambda e, c: match_blocked_fuzzy(e, c, min_score)):
        hit = stored(step(left, catalog))
        found = hit if found is None else found.unionByName(hit)
        left = left.join(hit.select("entry_id"), "entry_id", "left_anti")
    n = F.count("*").over(Window.partitionBy("entry_id"))
    out = found.dropDuplicates(["entry_id", "gsn"]).withColumn("status", F.when(n == 1, "matched").otherwise("ambiguous"))
    none = left.select("entry_id", F.lit(None).cast("string").alias("gsn"), F.lit(0.0).alias("score"), F.lit("unmatched").alias("status"))
    return out.unionByName(none)


def disambiguate(matches: DataFrame, entries: DataFrame, catalog: DataFrame) -> DataFrame:
    """entry_id, gsn, score, rule: one law an entry.

    Rules in order: the only candidate with the entry's abbreviation; the highest gsn among those of the entry's year;
    the highest gsn.
    """
    e = _entry(entries)
    m = matches.where("gsn is not null").join(e, "entry_id").join(_law(catalog), "gsn")
    exact = F.lower("abbrev") == F.lower("index_abbrev")
    year = F.coalesce(extract_year(F.col("index_name")), extract_year(F.col("index_abbrev")))
    same_year = F.coalesce(extract_year(F.col("name")) == year, F.lit(False))
    one = F.sum(exact.cast("int")).over(Window.partitionBy("entry_id")) == 1
    rank = F.when(one & exact, 3).when(~one & same_year, 2).otherwise(1)
    best = m.withColumn("rank", rank).groupBy("entry_id").agg(F.max_by(F.struct("gsn", "score", "rank"), F.struct("rank", "gsn")).alias("b"))
    rule = F.element_at(F.array(F.lit("newest"), F.lit("year"), F.lit("abbrev")), F.col("b.rank"))
    return best.select("entry_id", "b.gsn", "b.score", rule.alias("rule"))


def final_list(resolved: DataFrame, entries: DataFrame, catalog: DataFrame) -> DataFrame:
    """gsn, index_name, index_abbrev, catalog_name, catalog_typ, score: of each law the entry with the best score, the first of equals."""
    best = resolved.groupBy("gsn").agg(F.max_by(F.struct("entry_id", "score"), F.struct("score", -F.col("entry_id"))).alias("b")).select("gsn", "b.*")
    out = best.join(_entry(entries), "entry_id").join(_law(catalog), "gsn")
    return out.select("gsn", "index_name", "index_abbrev", F.col("name").alias("catalog_name"), F.col("typ").alias("catalog_typ"), "score")
