"""Rows delivered more than once: telling damaged texts from undamaged ones, one kept text per key.

A key is (gsn, fassung_vom, regular section id). Only keys whose rows hold different texts (in consistent form) need a
look at the texts; all others are settled by hashes. The different texts of a key are judged by token-level consensus:

1. Each text has a weight by its state: texts with signs of damage of their own (blank, broken characters, cut off,
   repeated) or boilerplate at an edge hardly count, texts that were delivered for another date as well count more.
   A line is boilerplate if it stands at the edge of texts of several sections, and mostly where the key's other texts
   lack it.
2. The texts are aligned progressively along a star: the heaviest, then longest text of the key makes the columns, all
   others are aligned to it one by one. A text is thus described by where it departs from the columns: other tokens,
   gaps, insertions (which open columns of their own).
3. Every text votes with its weight for its tokens. A token is accepted in a column if undamaged texts vote for it; a gap
   only if a text known from another date, or most of the weight, has it (otherwise what others have is missing there).
4. The damage of a text is the number of columns where it has what is not accepted. In a stretch where a text departs
   with accepted tokens of its own, it is another wording rather than a text that lacks something: gaps there are free.

No step holds a key's texts together: votes are sums by column and token, texts meet the column text in slices of at
most ``SLICE`` rows, and each text is scored by itself. Rows without rec_id, gsn, date or section id belong to no key
and are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.alignment import align, tokens_of
from ..functions.charforms import consistent_form
from ..functions.integrity import broken_characters, cut_off, repeats
from ..functions.section_ids import regular_id
from ..sources.stored import stored

KEY = ["gsn", "fassung_vom", "section"]
#: Rows of a key that meet the key's column text in one place.
SLICE = 4096
DAMAGED, INTACT, KNOWN = 0.001, 1.0, 3.0
#: Equal tokens in a row that show that two stretches of text belong together.
ANCHOR = 4
#: A boilerplate line stands at the edge of texts of so many sections, and in more than this share of its keys alone.
SECTIONS, SURPLUS = 2, 0.5
#: Kinds of departures: another token, a gap, an inserted token (before the column).
OTHER, GAP, INSERTED = 0, 1, 2
_DEPARTURES = "array<struct<col:int,kind:int,slot:long>>"


def keyed(fassung: DataFrame, *more: str | Column) -> DataFrame:
    """rec_id, the key, text_hash (of the consistent body), first_line, last_line (hashes) and the columns named; no row without a full key."""
    text = consistent_form(F.col("body"))
    rows = fassung.select("rec_id", "gsn", "fassung_vom", regular_id(F.col("section_id")).alias("section"), text.alias("_text"), *more)
    rows = rows.where(F.col("rec_id").isNotNull() & F.col("gsn").isNotNull() & F.col("fassung_vom").isNotNull() & F.col("section").isNotNull())

    def line(at: int) -> Column:
        # a blank line at the edge, as left by a line end, gives way to the one before or after
        outer = F.trim(F.substring_index("_text", "\n", at))
        inner = F.trim(F.substring_index(F.substring_index("_text", "\n", 2 * at), "\n", -at))
        found = F.coalesce(F.nullif(outer, F.lit("")), F.nullif(inner, F.lit("")))
        return F.when(found.isNotNull(), F.xxhash64(found))

    edges = {"first_line": line(1), "last_line": line(-1)}
    return rows.withColumns({"text_hash": text_hash(F.col("_text")), **edges}).drop("_text")


def text_hash(text: Column) -> Column:
    """One hash of 64 bits; null and empty texts have one in common."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def intrinsic_damage(text: str | None) -> float:
    """0 for a text without a sign of damage, more for worse signs."""
    if text is None or len(text.strip()) < 2:
        return 8.0
    return 4.0 * broken_characters(text) + 3.0 * repeats(text) + 2.0 * cut_off(text)


@F.pandas_udf(DoubleType())
def _intrinsic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(intrinsic_damage)


def departures(columns: Sequence[str], tokens: Sequence[str]) -> list[tuple[int, int, str, int]]:
    """(column, kind, token, occurrence) wherever ``tokens`` depart from ``columns``, in order.

    In a replaced stretch tokens and columns face each other in order; what is left over is a gap or inserted.
    Insertions before one column are told apart by token and occurrence.
    """
    out: list[tuple[int, int, str, int]] = []
    i = j = 0
    for p, q in [*align(columns, tokens), (len(columns), len(tokens))]:
        faced = min(p - i, q - j)
        out += [(i + k, OTHER, tokens[j + k], 0) for k in range(faced)]
        out += [(c, GAP, "", 0) for c in range(i + faced, p)]
        if j + faced < q:
            seen: Counter = Counter()
            for t in tokens[j + faced : q]:
                out.append((p, INSERTED, t, seen[t]))
                seen[t] += 1
        i, j = p + 1, q + 1
    # a word cut through at the end or the beginning of a text is missing, it is not another word
    for first, is_part, rest in ((1, str.startswith, range(len(columns) - 1, -1, -1)), (0, str.endswith, range(len(columns)))):
        at = next((k for k in range(len(out) - 1, -1, -1) if out[k][1] != GAP), None) if first else next((k for k in range(len(out)) if out[k][1] != GAP), None)
        if at is None or out[at][1] != OTHER or out[at][2] != (tokens[-1] if first else tokens[0]):
            continue
        gaps = len(out) - 1 - at if first else at
        if out[at][0] == rest[gaps] and is_part(columns[out[at][0]], out[at][2]):
            out[at] = (out[at][0], GAP, "", 0)
    return out


def cost(found: Sequence[tuple[int, int, bool]], n_columns: int) -> float:
    """The damage of a text from its departures (column, kind, accepted) in order, over ``n_columns`` columns."""
    # stretches: [equal columns before, gaps, wording of its own]
    stretches: list[list] = []
    total, end, inside = 0, 0, False
    for col, kind, good in found:
        if not inside or col > end:
            stretches.append([col - end, 0, False])
            inside = True
        if kind == GAP:
            stretches[-1][1] += not good
        else:
            stretches[-1][2] |= good
            total += not good
        end = col if kind == INSERTED else col + 1
    after = [*(x[0] for x in stretches[1:]), ANCHOR if end >= n_columns else n_columns - end]
    for k, ((before, gaps, own), behind) in enumerate(zip(stretches, after, strict=False)):
        # something is missing only between parts that are equal for a while, or at the end of such a part
        firm = (k == 0 or before >= ANCHOR) and (k == len(stretches) - 1 or behind >= ANCHOR)
        total += gaps if firm and not own else 0
    return float(total)


def accepted(kind: int, weight: float) -> bool:
    """Whether a departure is accepted that one text votes for against a column text of no less weight."""
    return weight >= (KNOWN if kind == GAP else INTACT)


def conflicting(fassung: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of all keys with different texts: key, rec_id, text_hash, text, weight, slots; each text once a key.

    ``rows`` comes from ``keyed`` over ``fassung`` (stored, as it is read several times). Hashes decide which keys
    these are; only one row of each of their texts is looked up in ``fassung``. ``slots`` is the number of slices.
    """
    keys = rows.groupBy(*KEY).agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"), (1 + F.floor(F.count("*") / SLICE)).cast("int").alias("slots")).where("lo != hi").select(*KEY, "slots")
    wanted = stored(rows.select("rec_id", *KEY, "text_hash", "first_line", "last_line").join(keys, KEY).groupBy(*KEY, "slots", "text_hash", "first_line", "last_line").agg(F.min("rec_id").alias("rec_id")))
    dates = rows.groupBy("gsn", "section", "text_hash").agg((F.min("fassung_vom") != F.max("fassung_vom")).alias("elsewhere"))
    state = wanted.join(dates, ["gsn", "section", "text_hash"], "left").join(_with_boilerplate(rows, wanted), ["rec_id"], "left").select("rec_id", *KEY, "slots", "text_hash", F.coalesce("elsewhere", F.lit(False)).alias("elsewhere"), F.coalesce("edge", F.lit(False)).alias("edge"))
    texts = fassung.select("rec_id", "body").join(state, "rec_id").withColumn("text", consistent_form(F.col("body")))
    weight = F.when((_intrinsic("text") > 0) | F.col("edge"), DAMAGED).when(F.col("elsewhere"), KNOWN).otherwise(INTACT)
    return texts.select(*KEY, "rec_id", "text_hash", "slots", weight.alias("weight"), "text").dropDuplicates([*KEY, "text_hash"])


def _with_boilerplate(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """rec_id, edge (true) of the texts in ``wanted`` with a boilerplate line at an edge."""
    lines = F.explode(F.array_distinct(F.array("first_line", "last_line"))).alias("line")
    # a line of a key is surplus if the key has other texts and just one of them has the line at an edge
    alone = stored(wanted.select(*KEY, "text_hash", lines).where("line is not null").groupBy(*KEY, "line").agg(F.count("*").alias("n")).where("n = 1").groupBy("line").agg(F.count("*").alias("surplus")))
    # lines that are surplus somewhere are few; only these are counted over all rows
    seen = rows.select(*KEY, lines).join(alone.select("line"), "line", "left_semi").groupBy("line", *KEY).agg(F.lit(1).alias("one"))
    counts = seen.groupBy("line", "gsn", "section").agg(F.count("*").alias("keys")).groupBy("line").agg(F.sum("keys").alias("keys"), F.count("*").alias("sections"))
    boilerplate = counts.join(alone, "line").where((F.col("surplus") > SURPLUS * F.col("keys")) & (F.col("sections") >= SECTIONS)).select("line")
    return wanted.select("rec_id", lines).join(boilerplate, "line", "left_semi").select("rec_id").distinct().withColumn("edge", F.lit(True))


def judged(conflicts: DataFrame) -> DataFrame:
    """key, text_hash, damage of every text of ``conflicting``: 0 for undamaged ones, more for worse ones."""
    texts = stored(conflicts)
    heaviest = F.struct("weight", F.length("text"), "text_hash")
    group = texts.groupBy(*KEY, "slots").agg(
        F.max_by(F.struct("rec_id", "text_hash", "text", "weight"), heaviest).alias("c"), F.sum("weight").alias("total"), (F.count("*") - 1).alias("members")
    )
    # the row of the column text stands for the key from here on
    group = group.select(*KEY, F.col("c.rec_id").alias("center"), F.col("c.text_hash").alias("center_hash"), F.coalesce("c.text", F.lit("")).alias("columns"), F.col("c.weight").alias("columns_weight"), "total", "members", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slice"))
    met = texts.withColumn("slice", F.pmod("text_hash", "slots").cast("int")).join(group, [*KEY, "slice"])
    aligned = stored(met.select("center", "rec_id", "columns", F.coalesce("text", F.lit("")).alias("text"), "weight", "columns_weight", "total", "members", (F.col("text_hash") == F.col("center_hash")).alias("own"), *KEY, "text_hash").mapInArrow(_aligned, _ALIGNED))
    # keys of two texts are settled by themselves: nobody else votes there
    voting = aligned.where("members > 1")
    cast = voting.select("center", "weight", "total", "columns_weight", "rec_id", F.explode("departures").alias("d")).select("center", "weight", "total", "columns_weight", "rec_id", "d.*")
    votes = cast.groupBy("center", "col", "kind", "slot", "total", "columns_weight").agg(F.sum("weight").alias("votes"), F.max("weight").alias("heaviest"))
    won = F.col("votes") > F.col("total") - F.col("votes")
    good = F.when(F.col("kind") == GAP, (F.col("heaviest") >= KNOWN) | (won & (F.col("columns_weight") >= INTACT))).otherwise(F.col("votes") >= INTACT)
    votes = stored(votes.select("center", "col", "kind", "slot", good.alias("good"), (won & (F.col("kind") != GAP) & (F.col("columns_weight") >= INTACT)).alias("won")))
    # inserted tokens that have most of the weight are missing wherever they are not
    due = votes.where((F.col("kind") == INSERTED) & F.col("won")).groupBy("center").agg(F.collect_list(F.struct("col", "slot")).alias("due"))
    scored = cast.join(votes, ["center", "col", "kind", "slot"]).groupBy("center", "rec_id").agg(F.collect_list(F.struct("col", "kind", "slot", "good", "won")).alias("found"))
    many = voting.select("center", "rec_id", "n_columns", "weight", *KEY, "text_hash").join(scored, ["center", "rec_id"], "left").join(due, "center", "left")
    many = many.select(*KEY, "text_hash", "weight", _scored("found", "due", "n_columns").alias("damage"))
    two = aligned.where("members <= 1").select(*KEY, "text_hash", "weight", "damage")
    return two.unionByName(many).select(*KEY, "text_hash", (F.col("damage") + F.when(F.col("weight") == DAMAGED, 0.5).otherwise(0.0)).alias("damage"))


_ALIGNED = f"center long, rec_id long, weight double, columns_weight double, total double, members long, n_columns int, departures {_DEPARTURES}, damage double, gsn string, fassung_vom string, section string, text_hash long"
_DEPARTURE_TYPE = pa.list_(pa.struct([("col", pa.int32()), ("kind", pa.int32()), ("slot", pa.int64())]))
_ALIGNED_TYPES = pa.schema([("center", pa.int64()), ("rec_id", pa.int64()), ("weight", pa.float64()), ("columns_weight", pa.float64()), ("total", pa.float64()), ("members", pa.int64()), ("n_columns", pa.int32()), ("departures", _DEPARTURE_TYPE), ("damage", pa.float64()), *((k, pa.string()) for k in KEY), ("text_hash", pa.int64())])


def _slot(token: str, occurrence: int) -> int:
    return xxhash.xxh3_64_intdigest(token, occurrence) - (1 << 63)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for center, rec_id, columns, text, weight, columns_weight, total, members, own, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            leaders = tokens_of(columns)
            found = [] if own else departures(leaders, tokens_of(text))
            damage, kept = None, []
            if members <= 1:
                damage = cost([(c, k, accepted(k, weight)) for c, k, _, _ in found], len(leaders))
            else:
                kept = [{"col": c, "kind": k, "slot": _slot(t, n)} for c, k, t, n in found]
            out.append((center, rec_id, weight, columns_weight, total, members, len(leaders), kept, damage, *key))
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(_ALIGNED_TYPES), _ALIGNED_TYPES, strict=True)], schema=_ALIGNED_TYPES)


def score(found: Sequence[dict], due: Sequence[dict], n_columns: int) -> float:
    """The damage of one text from its judged departures and the inserted tokens that its key mostly has."""
    mine = {(d["col"], d["slot"]) for d in found if d["kind"] == INSERTED}
    rows = [(d["col"], d["kind"] != INSERTED, d["kind"], d["good"]) for d in found if not d["won"]]
    # a missing insertion stands before its column, like the insertion itself
    rows += [(d["col"], False, INSERTED + 1, False) for d in due if (d["col"], d["slot"]) not in mine]
    rows.sort()
    gaps = sum(kind > INSERTED for _, _, kind, _ in rows)
    return cost([(c, kind, good) for c, _, kind, good in rows if kind <= INSERTED], n_columns) + gaps


@F.pandas_udf(DoubleType())
def _scored(found: pd.Series, due: pd.Series, n_columns: pd.Series) -> pd.Series:
    return pd.Series([score([] if f is None else f, [] if d is None else d, n) for f, d, n in zip(found, due, n_columns, strict=True)], dtype="float64")


def ranked(rows: DataFrame, quellen: DataFrame) -> DataFrame:
    """``rows`` with ``rang`` of their source; an unknown or null source ranks last. Extra columns of quellen are ignored."""
    ranks = quellen.select(F.col("quelle").alias("quelle"), F.col("rang").cast("int").alias("rang")).groupBy("quelle").agg(F.min("rang").alias("rang"))
    return rows.join(ranks, "quelle", "left").withColumn("rang", F.coalesce("rang", F.lit(2**31 - 1)))


def best(rows_order: Sequence[str] = ()) -> Column:
    """Sort key, smallest first: lowest rank, latest load (none last), lowest rec_id."""
    late = F.coalesce(-F.unix_micros(F.col("geladen_am").cast("timestamp")), F.lit(2**62))
    return F.struct(*rows_order, F.col("rang"), late.alias("late"), F.col("rec_id"))


def with_damage(fassung: DataFrame, quellen: DataFrame, *more: str | Column) -> DataFrame:
    """The rows of ``keyed`` with ``rang`` and ``damage`` of their text; texts that no other text contradicts have 0."""
    rows = stored(keyed(fassung, "quelle", "geladen_am", *more))
    damage = judged(conflicting(fassung, rows))
    return ranked(rows, quellen).join(damage, [*KEY, "text_hash"], "left").withColumn("damage", F.coalesce("damage", F.lit(0.0)))


def kept_texts(fassung: DataFrame, quellen: DataFrame) -> DataFrame:
    """One row a key: gsn, fassung_vom, section, rec_id and text_hash of the row whose body is kept.

    Kept is an undamaged text, among several that of the lowest source rank, then of the latest load, then of the
    lowest rec_id. If all are damaged, the least damaged one is kept.
    """
    rows = with_damage(fassung, quellen)
    return rows.groupBy(*KEY).agg(F.min_by(F.struct("rec_id", "text_hash"), best(["damage"])).alias("_b")).select(*KEY, "_b.rec_id", "_b.text_hash")
