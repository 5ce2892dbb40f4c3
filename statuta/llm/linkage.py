"""Matching laws across registers that share no identifier, by probabilistic record linkage.

1. Each record becomes a set of attributes: the stem and the kind of its principal word, the words of its scope, years,
   abbreviation, gazette reference, type, and whether it amends another law. Which words belong to the scope is
   learnt: words frequent in the catalog. Frequent means a fixed share of all rows, so their number is bounded.
2. Blocking in several passes, each tolerant of errors elsewhere: principal word and one scope word, all texts one
   deletion away from the stem with the scope, gazette reference, abbreviation. Only pairs of one block are compared.
3. Each pair is reduced to agreement levels of its attributes; no pair is ruled out. The counts of the level patterns (a
   table bounded by the product of the numbers of levels) feed expectation-maximisation, which estimates the match and
   the non-match probabilities of every level: that another kind, scope or year makes another law, and how much a
   wrong gazette or a missing abbreviation speaks against a match, is learnt from the pairs. Pairs formed at random
   give the non-match probabilities to begin with.
4. An entry's laws compete: the confidence of a law is its odds over those of all laws compared with the entry and of
   none. An entry is linked to its most confident law if that reaches ``CONFIDENT``, so two laws that fit equally
   well leave it unmatched. Equal records are compared once.

Null, empty and blank attributes are missing: they count neither for nor against a match. Records without a name can
still be linked by abbreviation and gazette.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.charforms import consistent
from ..sources.stored import stored

CONFIDENT = 0.5
#: A block of more pairs than this is split into blocks of about as many, all of which are compared.
HOT = 1_000_000
#: Attributes that tell one law from another, and the highest level of each that disagrees.
OTHER_LAW = {"name": 1, "kind": 0, "year": 1, "amends": 0}
#: A word that stands in at least this share of the catalog's names (and in three names) is a frequent word.
FREQUENT = 0.01
# Kinds of laws and how registers shorten them at the end of a word.
KINDS = {
    "gesetzbuch": ("gesetzbuch",),
    "gesetz": ("gesetz", "ges", "g"),
    "verordnung": ("verordnung", "verordng", "vdg", "vo", "v"),
    "kundmachung": ("kundmachung", "kundm", "kdm"),
    "statut": ("statut", "stat", "st"),
}
_SHORTS = sorted(((s, kind) for kind, shorts in KINDS.items() for s in shorts[1:]), key=lambda x: (-len(x[0]), x))
# Words of a name that say nothing about which law it is.
FILLERS = frozenset("bg bundesgesetz ueber betreffend betr fuer vom der die das des und mit dem wird geaendert aenderung von bei zur zum in".split())
MONTHS = frozenset("jaenner januar februar feber maerz april mai juni juli august september oktober november dezember".split())
_FOLD = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"})
_YEAR = re.compile(r"\b(1[89]\d\d|20\d\d)\b")
_AMENDS = re.compile(r"(?i)\b(ge(ä|ae)ndert\b|(ä|ae)nderung\b|novelle\b|mit dem das\b)")
_GAZETTE = re.compile(r"(\d{1,4})\s*(?:/|aus)\s*(\d{4}|\d{2})\b")
_NOTE = re.compile(r"\((?:dort|Bezeichnung|griechisch|im Original|[^()]*[„“])[^()]*\)|„[^“]*“")
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)*\.?")


#: Words a worker remembers the reading of.
REMEMBERED = 200_000


def edits(a: str, b: str, most: int) -> int:
    """Edits (swaps of neighbours count one) between two words, or most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def folded(name: str | None) -> str:
    """A name in consistent form, lower case and without umlauts; notes on other names are left out."""
    if not name:
        return ""
    text = _NOTE.sub(" ", consistent(name) or "")
    text = re.sub(r"^\s*\d+\.\s+", " ", text)
    return unicodedata.normalize("NFC", text).lower().translate(_FOLD)


def words_of(name: str | None) -> list[str]:
    """The words of a folded name that may tell laws apart; parts joined by hyphens are one word, a dot marks a short form."""
    out = []
    for w in _WORD.findall(folded(name)):
        w = w.replace("-", "")
        bare = w.rstrip(".")
        if bare and bare not in FILLERS and bare not in MONTHS and bare not in KINDS:
            out.append(w if w.endswith(".") else bare)
    return out


@lru_cache(REMEMBERED)
def names_a_kind(word: str) -> bool:
    """Whether a word ends with the kind of a law in full, so that it is a principal word however frequent it is."""
    return any(len(word) > len(k) + 2 and edits(word[-len(k) :], k, 1) <= 1 for k in KINDS)


@lru_cache(REMEMBERED)
def split_kind(word: str) -> tuple[str, str]:
    """(stem, kind) of a principal word, its kind possibly shortened or misspelt; kind "" if it shows none."""
    bare = word.rstrip(".")
    best = (3, "", "")
    for kind in KINDS:
        for k in range(max(3, len(kind) - 2), len(kind) + 3):
            if len(bare) > k + 2 and (d := edits(bare[-k:], kind, 2)) <= 2 and (d, -len(kind)) < (best[0], -len(best[2])):
                best = (d, bare[:-k], kind)
    if best[2]:
        return best[1], best[2]
    for s, kind in _SHORTS:
        if bare.endswith(s) and len(bare) > len(s) + 3:
            return bare[: -len(s)], kind
    return bare, ""


def as_frequent(word: str, frequent: dict[str, list[str]]) -> str | None:
    """The frequent word that a word is, shortens or misspells."""
    bare = word.rstrip(".")
    if len(bare) < 4:
        return None
    near = frequent.get(bare[:2], []) + (frequent.get("?" + bare[-3:], []))
    if bare in near:
        return bare
    starts = [w for w in near if w.startswith(bare)]
    if starts and (word.endswith(".") or len(bare) >= 5):
        return min(starts, key=len)
    close = sorted((d, w) for w in set(near) if (d := edits(bare, w, 2)) <= 2)
    if close:
        return close[0][1]
    # a shortened and misspelt form
    cut = sorted((d, w) for w in set(near) if len(bare) >= 5 and (d := edits(bare, w[: len(bare)], 1)) <= 1)
    return cut[0][1] if cut else None


def attributes(name: str | None, abbrev: str | None, typ: str | None, gazette: str | None, frequent: Callable[[str], str | None]) -> dict:
    """The attributes of one record; missing ones are None. ``frequent`` gives the frequent word that a word is."""
    text = folded(name)
    scope, rest = [], []
    for w in words_of(name):
        stem, kind = split_kind(w)
        known = frequent(w)
        if known and not (kind and known != w.rstrip(".") and len(stem) >= 5 and not known.startswith(w.rstrip("."))):
            scope.append(known)
        else:
            rest.append((bool(kind), len(w), stem, kind))
    main = max(rest, default=None)
    short = re.sub(r"[^a-z0-9]", "", re.sub(r"\b(19|20)\d\d\b", "", (consistent(abbrev or "") or "").lower().translate(_FOLD)))
    ref = _GAZETTE.search(consistent(gazette or "") or "")
    ref_year = None
    if ref:
        y = int(ref[2])
        ref_year = y if y > 99 else None
    years = _YEAR.findall(re.sub(r"\bvom\b[^,:;]*?(?=ueber)", " ", text))
    return {
        "stem": main[2] if main else None,
        "kind": (main[3] if main else "") or None,
        "scope": sorted(set(scope)) or None,
        "year": int(years[-1]) if years else None,
        "abbrev": short or None,
        "ref_no": int(ref[1]) if ref else None,
        "ref_year": ref_year,
        "ref_two": int(ref[2]) % 100 if ref else None,
        "typ": (consistent(typ or "") or "").strip().upper() or None,
        "amends": bool(_AMENDS.search(consistent(name) or "")),
    }


FIELDS = "stem string, kind string, scope array<string>, year int, abbrev string, ref_no int, ref_year int, ref_two int, typ string, amends boolean"
_NAMES = [x.split()[0] for x in FIELDS.split(", ")]
_TYPES = [pa.string(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_()]


def frequent_words(names: DataFrame, name: str, share: float = FREQUENT) -> list[str]:
    """The words in at least ``share`` of the names (and in three), principal words aside. At most words-per-name / share of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([w for n in batch[0].to_pylist() for w in sorted(set(words_of(n))) if not w.endswith(".") and not names_a_kind(w)], pa.string())], names=["word"])

    words = names.select(name).mapInArrow(run, "word string").groupBy("word").agg(F.count("*").alias("n"))
    least = max(3, share * names.count())
    return sorted(r.word for r in words.where((F.col("n") >= least) & (F.length("word") >= 4)).collect())


def with_attributes(records: DataFrame, rec_id: str, columns: list[str], frequent: list[str]) -> DataFrame:
    """rec_id and the attributes (``FIELDS``); ``columns`` names name, abbreviation, type and gazette reference."""
    near: dict[str, list[str]] = {}
    for w in frequent:
        near.setdefault(w[:2], []).append(w)
        near.setdefault("?" + w[-3:], []).append(w)
    schema = pa.schema([("rec_id", pa.int64()), *zip(_NAMES, _TYPES, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(REMEMBERED)(lambda w: as_frequent(w, near))
        for batch in batches:
            rows = [attributes(*r, read) for r in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([batch[0], *(pa.array([r[n] for r in rows], t) for n, t in zip(_NAMES, _TYPES, strict=True))], schema=schema)

    return records.select(F.col(rec_id).cast("long").alias("rec_id"), *columns).mapInArrow(run, "rec_id long, " + FIELDS)


def block_keys() -> Column:
    """The keys of all passes of a record, as hashes; a pass whose attributes are missing gives none."""
    scope = F.coalesce("scope", F.array().cast("array<string>"))
    stem, n = F.col("stem"), F.length("stem")
    all_scope = F.concat_ws(" ", scope)

    def key(no: int, *parts: Column) -> Column:
        return F.when(F.concat(*parts).isNotNull(), F.xxhash64(F.lit(no), *parts))

    whole = [F.transform(F.when(F.size(scope) > 0, scope).otherwise(F.array(F.lit(""))), lambda w: key(1, stem, F.coalesce("kind", F.lit("")), w))]
    # all strings one deletion away from the stem, and the stem itself
    near = F.transform(F.sequence(F.lit(0), n), lambda i: key(2, F.concat(F.substr(stem, F.lit(1), i), F.substr(stem, i + 2, n)), all_scope))
    reference = F.array(key(3, F.col("ref_no"), F.col("ref_two"), F.substring("stem", 1, 3)), key(4, F.col("abbrev"), F.substring("stem", 1, 4)), key(5, F.col("abbrev"), F.col("ref_no"), F.col("ref_two")), key(6, F.col("abbrev"), F.when(all_scope != "", all_scope)), key(7, F.col("ref_no"), F.col("ref_two"), F.when(all_scope != "", all_scope)))
    return F.array_distinct(F.array_compact(F.concat(F.coalesce(whole[0], F.array().cast("array<bigint>")), F.coalesce(near, F.array().cast("array<bigint>")), reference)))


def split_hot(left: DataFrame, right: DataFrame, most: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Both sides with the keys of hot blocks (more than ``most`` pairs) split up; every pair of a block still meets, once.

    The rows of either side fall into slots by hash. A row of one side goes to all slots of the other, so that a pair
    of slots, with about ``most`` pairs of rows, is a block of its own.
    """
    counts = [df.groupBy("key").agg(F.count("*").alias(n)) for df, n in ((left, "n"), (right, "m"))]
    side = max(1, int(most**0.5))
    slots = [F.ceil(F.col(n) / side).cast("int").alias(s) for n, s in (("n", "p"), ("m", "q"))]
    hot = stored(counts[0].join(counts[1], "key").where(F.col("n") * F.col("m") > most).select("key", *slots))

    def split(df: DataFrame, r: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(r), F.col(own)).cast("int")
        all_keys = F.transform(F.sequence(F.lit(0), F.col(other) - 1), lambda k: F.xxhash64("key", *((mine, k) if own == "p" else (k, mine))))
        return df.join(hot, "key", "left").select(r, F.explode(F.when(F.col(own).isNotNull(), all_keys).otherwise(F.array("key"))).alias("key"))

    return split(left, "e", "p", "q"), split(right, "c", "q", "p")


def levels(a: str = "e", b: str = "c") -> dict[str, Column]:
    """The agreement level of each attribute of a pair, from 0 (disagree) up; -1 where one side lacks it."""

    def both(c: str) -> tuple[Column, Column]:
        return F.col(f"{a}.{c}"), F.col(f"{b}.{c}")

    def equal(c: str) -> Column:
        x, y = both(c)
        return F.when(x.isNull() | y.isNull(), -1).otherwise((x == y).cast("int"))

    s, t = both("stem")
    d = F.levenshtein(s, t)
    longest = F.greatest(F.length(s), F.length(t))
    p, q = both("scope")
    shared, sizes = F.size(F.array_intersect(p, q)), (F.size(p), F.size(q))
    y, z = both("year")
    ry, rz = F.col(f"{a}.ref_year"), F.col(f"{b}.ref_year")
    no, mo = both("ref_no")
    two = F.col(f"{a}.ref_two") == F.col(f"{b}.ref_two")
    full = F.coalesce(ry == rz, two)
    stem = F.when(s == t, 3).when((d <= 2) & (longest >= 6), 2).when((d <= 3) & (longest >= 10), 1).otherwise(0)
    # 3 equal, 2 one side lacks words of the other, 1 not known, 0 another scope
    scope = F.when(p.isNull() | q.isNull(), 1).when((shared == sizes[0]) & (shared == sizes[1]), 3).when((shared == sizes[0]) | (shared == sizes[1]), 2).otherwise(0)
    return {
        # stem and scope are one attribute, as the blocking makes each depend on the other
        "name": F.when(s.isNull() | t.isNull(), -1).when((stem == 3) & (scope == 3), 6).when((stem == 2) & (scope == 3), 5).when((stem == 3) & (scope >= 1), 4).when((stem == 1) & (scope == 3), 3).when((stem >= 1) & (scope >= 1), 2).when(stem >= 1, 1).otherwise(0),
        "kind": equal("kind"),
        # a year named on one side only may agree with the other side's gazette; one that the catalog alone names may be left out
        "year": F.when(y.isNotNull() & z.isNotNull(), F.when(y == z, 3).otherwise(0)).when(F.coalesce(y == rz, F.lit(False)), 2).when(F.coalesce(z == ry, F.lit(False)), 2).when(y.isNotNull(), 1).otherwise(-1),
        "abbrev": F.when(both("abbrev")[0].isNull() | both("abbrev")[1].isNull(), -1).when(both("abbrev")[0] == both("abbrev")[1], 2).when(F.levenshtein(*both("abbrev")) <= 1, 1).otherwise(0),
        "ref": F.when(no.isNull() | mo.isNull(), -1).when((no == mo) & full, 2).when((no == mo) | full, 1).otherwise(0),
        "typ": equal("typ"),
        "amends": F.when(F.col(f"{a}.amends") == F.col(f"{b}.amends"), 1).otherwise(0),
    }


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, random_patterns: np.ndarray, random_counts: np.ndarray, misses: Sequence[tuple[int, int]], rounds: int = 500) -> np.ndarray:
    """The log odds of a match of each pattern (rows of levels, -1 missing) seen ``counts`` times among the blocked pairs.

    Blocking brings together what is alike, so pairs that don't match are of several kinds: near misses, which disagree
    in an attribute that tells one thing from another (``misses``: its column and the highest level that disagrees) and
    may be like a match otherwise, and pairs that start like those formed at random, which disagree in the first of
    these attributes. The non-match probability of a pattern is a mixture of these. All probabilities and the shares of the kinds are estimated from the blocked pairs; they start
    from the assumption that higher levels are likelier in matches. Missing levels are left out of the products, so
    they speak neither way, but a near miss needs a level to disagree in.
    """
    n, k = patterns.shape
    tops = [max(int(patterns[:, j].max(initial=0)), int(random_patterns[:, j].max(initial=0))) for j in range(k)]

    def shares(rows: np.ndarray, weights: np.ndarray, j: int, most: int | None = None) -> np.ndarray:
        seen = rows[:, j] >= 0
        total = np.bincount(rows[seen, j], weights[seen], tops[j] + 1) + 0.5
        if most is not None:
            total[most + 1 :] = 1e-12
        return total / total.sum()

    telling = {j for j, _ in misses}
    alike = [np.array([(0.001 if j in telling and x == 0 else 0.1) ** (t - x) for x in range(t + 1)]) for j, t in enumerate(tops)]
    alike = [x / x.sum() for x in alike]
    limits: list[dict[int, int]] = [{}, *({j: most} for j, most in misses), dict(misses[:1])]
    classes = [[shares(np.arange(tops[j] + 1)[:, None].repeat(k, 1), np.ones(tops[j] + 1), j, limit[j]) if j in limit else alike[j] for j in range(k)] for limit in limits[:-1]]
    classes.append([shares(random_patterns, random_counts, j) for j in range(k)])
    prior = np.full(len(classes), 1 / len(classes))
    last = np.zeros(n)
    for _ in range(rounds):
        log = np.tile(np.log(prior), (n, 1))
        for c, by_level in enumerate(classes):
            for j in range(k):
                seen = patterns[:, j] >= 0
                log[seen, c] += np.log(by_level[j][patterns[seen, j]])
                if j in limits[c]:
                    log[~seen, c] += np.log(1e-12)
        held = np.exp(log - log.max(axis=1, keepdims=True))
        held /= held.sum(axis=1, keepdims=True)
        weights = held * counts[:, None]
        classes = [[shares(patterns, weights[:, c], j, limits[c].get(j)) for j in range(k)] for c in range(len(classes))]
        prior = (weights.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * len(classes))
        if np.abs(held[:, 0] - last).max() < 1e-9:
            break
        last = held[:, 0]
    rest = log[:, 1:].max(axis=1)
    return np.clip(log[:, 0] - rest - np.log(np.exp(log[:, 1:] - rest[:, None]).sum(axis=1)), -700, 700)


def link(entries: DataFrame, catalog: DataFrame) -> DataFrame:
    """entry_id, gsn, confidence of the best law of each entry that has one.

    ``entries``: entry_id, index_name, index_abbrev, index_typ, index_fundstelle. ``catalog``: cat_id, gsn, name,
    abbrev, typ, kundmachungsorgan. Further columns are ignored.
    """
    frequent = frequent_words(catalog, "name")
    e = stored(with_attributes(entries, "entry_id", ["index_name", "index_abbrev", "index_typ", "index_fundstelle"], frequent).withColumn("keys", block_keys()))
    c = with_attributes(catalog.where("gsn is not null"), "cat_id", ["name", "abbrev", "typ", "kundmachungsorgan"], frequent)
    c = stored(c.join(catalog.select(F.col("cat_id").cast("long").alias("rec_id"), "gsn"), "rec_id").drop("rec_id").distinct().withColumn("keys", block_keys()))
    fields = ["stem", "kind", "scope", "year", "abbrev", "ref_no", "ref_year", "ref_two", "typ", "amends"]
    # equal records of the register are compared once
    sets = e.groupBy(*fields).agg(F.first("keys").alias("keys")).withColumn("id", F.xxhash64(*fields))
    left = sets.select(F.struct("id", *fields).alias("e"), F.explode("keys").alias("key"))
    right = c.select(F.struct("gsn", *fields).alias("c"), F.explode("keys").alias("key"))
    left, right = split_hot(left, right)
    pairs = left.join(right, "key").select(F.col("e.id").alias("id"), F.col("c.gsn").alias("gsn"), *(x.alias(k) for k, x in levels().items()))
    names = list(levels())
    pairs = stored(pairs.select("id", "gsn", *names).distinct())
    table = pairs.groupBy(*names).agg(F.count("*").alias("n")).collect()  # bounded by the levels' product
    # as many pairs at random as a few for each record: rows meet whose hashes fall into the same of many slots
    slots = F.lit(max(1, max(e.count(), c.count()) // 4))
    meet = sets.select(F.struct("id", *fields).alias("e"), F.pmod("id", slots).alias("slot")).join(c.select(F.struct("gsn", *fields).alias("c"), F.pmod(F.xxhash64("gsn", *fields), slots).alias("slot")), "slot")
    chance = meet.select(*(x.alias(k) for k, x in levels().items())).groupBy(*names).agg(F.count("*").alias("n")).collect()  # bounded likewise
    spark = entries.sparkSession
    schema = ", ".join(f"{x} int" for x in names) + ", log_odds double"
    if table:
        patterns = np.array([[r[x] for x in names] for r in table])
        by_chance = np.array([[r[x] for x in names] for r in chance]).reshape(-1, len(names))
        log_odds = expectation_maximisation(patterns, np.array([r.n for r in table], float), by_chance, np.array([r.n for r in chance], float), [(names.index(x), most) for x, most in OTHER_LAW.items()])
        scores = spark.createDataFrame([(*(r[x] for x in names), float(p)) for r, p in zip(table, log_odds, strict=True)], schema)
    else:
        scores = spark.createDataFrame([], schema)
    # a law counts once, by its best record; all laws of an entry, and none, share its certainty
    laws = pairs.join(F.broadcast(scores), names).groupBy("id", "gsn").agg(F.max("log_odds").alias("log_odds"))
    best = laws.groupBy("id").agg(F.max_by(F.struct("gsn", "log_odds"), F.struct("log_odds", "gsn")).alias("b"), F.sum(F.exp(F.least("log_odds", F.lit(300.0)))).alias("odds"))
    confidence = F.exp(F.least(F.col("b.log_odds"), F.lit(300.0))) / (1 + F.col("odds"))
    best = best.select("id", "b.gsn", confidence.alias("confidence")).where(F.col("confidence") >= CONFIDENT)
    return e.select(F.col("rec_id").alias("entry_id"), F.xxhash64(*fields).alias("id")).join(best, "id").select("entry_id", "gsn", "confidence")
