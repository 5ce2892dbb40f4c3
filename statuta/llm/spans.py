"""Long exact spans shared between records.

Two texts share a run of at least ``SPAN`` characters if and only if they have a window of ``SPAN`` characters in
common. Comparing all windows would move a hash for every character, so candidates come from compact windows:

1. Tokens are the ``GRAM``-character substrings at every position, each with a pseudo-random hash. The Cartesian tree
   over a text's token hashes groups its subsequences by the position c of their (leftmost) least hash: all
   subsequences that start in [l, c] and end in [c, r] share the min-hash of c, and form the compact window (l, c, r).
   Only windows that hold a subsequence of ``SPAN - GRAM + 1`` tokens, those of one span, are made: about
   2 n / (SPAN - GRAM) in a text of n characters. The tree is built from the top, by leftmost minima.
2. Windows of different texts with the same min-hash are joined. A span that two records share holds the same
   tokens in both, so its least token is the same: one min-hash finds every shared span.
3. Verification: of windows that met another record's, the starts of all spans with this least token (an interval
   given by l, c and r) are hashed over their whole ``SPAN`` characters, by two independent hashes (96 bits).
   Equal hashes of two records are shared spans.

Copies of a text are one text in all of this; their pairs are added at the end. Verified spans are grouped by hash. Consecutive spans of a passage have the same set of records; each such set is
expanded into pairs once. A frequent token that many records hold, but in different surroundings, costs its windows'
rows and no pairs. Every row has the same part in the work whether its text is long, short or repeated.

Null and empty texts and texts under ``SPAN`` characters share nothing. Characters are code points, not normalised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import discard, stored

SPAN = 200
GRAM = 100
_B1, _B2 = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03  # odd multipliers of the rolling hashes
_CHARS_AT_A_TIME = 400_000
_ROWS_AT_A_TIME = 50_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Hashes of all substrings of one length, from prefix sums modulo 2^64."""

    def __init__(self, codes: np.ndarray, base: int) -> None:
        n = len(codes)
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(_mix(codes.astype(_U) + _U(base)) * _powers(base, n), out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return _mix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])

    def all(self, length: int) -> np.ndarray:
        return _mix((self.sums[length:] - self.sums[:-length]) * self.inverse[: len(self.sums) - length])


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, _U)
        have[0] = 1
        _POWERS[base] = have = np.cumprod(have, dtype=_U)
    return have[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def compact_windows(h: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(l, c, r) of all compact windows over token hashes ``h`` that hold a subsequence of ``width`` tokens.

    [l, r] is the widest stretch whose leftmost minimum is at c. Equal minima split a stretch all at once, so that
    texts of one repeated character take linear time.
    """
    out = []
    todo = [(0, len(h))]
    while todo:
        a, b = todo.pop()
        if b - a < width:
            continue
        part = h[a:b]
        c = int(part.argmin())
        out.append((a, a + c, b - 1))
        # further positions of the same value to the right of c: each is a window from just after the one before
        ties = np.flatnonzero(part[c + 1 :] == part[c]) if b - a - c > width else ()
        todo.append((a, a + c))
        start = a + c + 1
        for t in ties:
            at = a + c + 1 + int(t)
            if b - start >= width:
                out.append((start, at, b - 1))
            todo.append((start, at))
            start = at + 1
        todo.append((start, b))
    return out


def _texts(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[tuple[int, np.ndarray, list]]:
    for batch in batches:
        ids, texts = batch[0].to_pylist(), batch[1].to_pylist()
        rest = [c.to_pylist() for c in batch.columns[2:]]
        for k, (i, t) in enumerate(zip(ids, texts, strict=True)):
            if t is not None and len(t) >= span:
                yield i, code_points(t), [c[k] for c in rest]


def windows(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc, token, first, last: the compact windows of every text, as the interval of the spans' starts."""
    width = span - gram + 1
    schema = pa.schema([("doc", pa.int64()), ("token", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_, tokens, wins, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            w = np.array(wins, np.int64).reshape(-1, 3)
            # a span starting at s holds the tokens s .. s + width - 1, c among them, within [l, r]
            first, last = np.maximum(w[:, 0], w[:, 1] - width + 1), np.minimum(w[:, 1], w[:, 2] - width + 1)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs_)), pa.array(np.concatenate(tokens).view(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], schema=schema)

        for doc, codes, _ in _texts(batches, span):
            h = Rolling(codes, _B1).all(gram)
            found = compact_windows(h, width)
            docs_.append(np.full(len(found), doc))
            tokens.append(h[[c for _, c, _ in found]])
            wins += found
            n += len(codes)
            if n > _CHARS_AT_A_TIME:
                yield flush()
                docs_, tokens, wins, n = [], [], [], 0
        if wins:
            yield flush()

    return docs.mapInArrow(run, "doc long, token long, first int, last int")


def met_hashes(documents: DataFrame, text: str = "text", span: int = SPAN) -> DataFrame:
    """The hashes that different texts have in common (a stored table, of no rows but for chance); a second hash tells the texts apart."""
    both = documents.where(F.length(text) >= span).select(F.xxhash64(text).alias("doc"), F.xxhash64(text, F.lit(1)).alias("check"))
    return stored(both.groupBy("doc").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo != hi").select("doc", F.lit(True).alias("met")))


def _with_doc(documents: DataFrame, text: str, span: int, met: DataFrame) -> DataFrame:
    """Records of ``span`` characters or more with ``doc``, which stands for their text: its hash, or the second one where texts meet in the first."""
    rows = documents.where(F.length(text) >= span).withColumn("doc", F.xxhash64(text)).join(met, "doc", "left")
    return rows.withColumn("doc", F.when(F.col("met"), F.xxhash64(F.col("doc"), F.xxhash64(text, F.lit(1)))).otherwise(F.col("doc"))).drop("met")


def members(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, met: DataFrame | None = None) -> DataFrame:
    """doc_id, doc of every record of ``span`` characters or more: doc stands for its text, alike for copies."""
    met = met_hashes(documents, text, span) if met is None else met
    return _with_doc(documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", span, met).select("doc_id", "doc")


def candidate_spans(documents: DataFrame, text: str = "text", span: int = SPAN, gram: int = GRAM, met: DataFrame | None = None) -> DataFrame:
    """doc, at, first_here, h1, h2 of every start of a span whose least token another text has too (a stored table).

    doc stands for the whole text, so that copies count as one text. first_here marks the first of equal spans
    within a text. h1 and h2 (64 and 32 bits) are hashes of the whole span.
    """
    met = met_hashes(documents, text, span) if met is None else met
    docs = _with_doc(documents.select(F.col(text).alias("text")), "text", span, met).select("doc", "text")
    found = stored(windows(docs, span, gram))
    # stored, so that its size is known when the join is planned: only a small one is broadcast
    shared = stored(found.groupBy("token").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo != hi").select("token"))
    starts = found.join(shared, "token", "left_semi").select("doc", F.struct("first", "last").alias("w"))
    starts = starts.groupBy("doc").agg(F.collect_set("w").alias("ws"))  # bounded by the text's own length
    schema = pa.schema([("doc", pa.int64()), ("at", pa.int32()), ("first_here", pa.bool_()), ("h1", pa.int64()), ("h2", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            for k in range(0, n, _ROWS_AT_A_TIME):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + _ROWS_AT_A_TIME]) for c in columns], schema=schema)

        for doc, codes, (ws,) in _texts(batches, span):
            at = np.unique(np.concatenate([np.arange(w["first"], w["last"] + 1) for w in ws]))
            h1, h2 = Rolling(codes, _B1).at(at, span), Rolling(codes, _B2).at(at, span)
            once = np.zeros(len(at), bool)
            once[np.unique(h1, return_index=True)[1]] = True
            h2 = (h2 >> _U(32)).astype(np.uint32).view(np.int32)
            parts.append((np.full(len(at), doc), at.astype(np.int32), once, h1.view(np.int64), h2))
            n += len(at)
            if n >= _ROWS_AT_A_TIME:
                yield from flush()
                parts, n = [], 0
        if n:
            yield from flush()

    hashed = stored(docs.join(starts, "doc").dropDuplicates(["doc"]).select("doc", "text", "ws").mapInArrow(run, "doc long, at int, first_here boolean, h1 long, h2 int"))
    discard(found)
    return hashed


def shared_spans(candidates: DataFrame) -> DataFrame:
    """The rows of ``candidate_spans`` whose span another text holds as well."""
    shared = candidates.groupBy("h1", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo != hi").select("h1", "h2")
    return candidates.join(shared, ["h1", "h2"], "left_semi")


def text_pairs(candidates: DataFrame) -> DataFrame:
    """a, b (a < b) of every two texts that hold one of ``candidate_spans``; each pair once."""
    held = candidates.where("first_here").select("h1", "h2", "doc")
    # spans with the same set of texts: number, least, greatest and sum without carry of the texts' hashes tell the
    # sets apart; one span stands for each set
    prints = [f("doc").alias(k) for k, f in (("lo", F.min), ("hi", F.max), ("x", F.bit_xor), ("n", F.count))]
    sets = held.groupBy("h1", "h2").agg(*prints).where("n > 1").groupBy("lo", "hi", "x", "n").agg(F.min(F.struct("h1", "h2")).alias("h"))
    sets = stored(sets)
    two = sets.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    held = held.join(sets.where("n > 2").select("h.h1", "h.h2"), ["h1", "h2"], "left_semi")
    a, b = held.withColumnRenamed("doc", "a"), held.withColumnRenamed("doc", "b")
    return two.unionByName(a.join(b, ["h1", "h2"]).where("a < b").select("a", "b")).distinct()


def record_pairs(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """doc_id_a, doc_id_b (a < b) of every two records (from ``members``) whose texts are a pair or the same."""
    side = lambda k: records.select(F.col("doc").alias(k), F.col("doc_id").alias(f"doc_id_{k}"))
    different = pairs.join(side("a"), "a").join(side("b"), "b").select(F.least("doc_id_a", "doc_id_b").alias("doc_id_a"), F.greatest("doc_id_a", "doc_id_b").alias("doc_id_b"))
    copy = lambda k: records.select("doc", F.col("doc_id").alias(f"doc_id_{k}"))
    same = copy("a").join(copy("b"), "doc").where("doc_id_a < doc_id_b").select("doc_id_a", "doc_id_b")
    return different.where("doc_id_a < doc_id_b").unionByName(same).distinct()


def linked_classes(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """doc_id, class_id, n_copies, n_links of every record of ``members``; no pair is expanded.

    The class is that of all copies of a text (its id is the least doc_id); n_links counts the other texts that share a
    span with it.
    """
    classes = records.groupBy("doc").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_copies"))
    links = pairs.select(F.explode(F.array("a", "b")).alias("doc")).groupBy("doc").agg(F.count("*").alias("n_links"))
    return records.join(classes, "doc").join(links, "doc", "left").select("doc_id", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def shared_share(documents: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, met: DataFrame | None = None) -> DataFrame:
    """doc_id, n_chars, shared_chars, share of every record: how many of its characters lie in a span held elsewhere.

    ``spans`` comes from ``shared_spans``. A copy is shared as a whole if it has ``span`` characters. Null texts have
    n_chars 0; the share of an empty text is 0.
    """
    # each start covers the characters up to the next one, at most ``span``
    nxt = F.lead("at").over(Window.partitionBy("doc").orderBy("at"))
    covered = spans.select("doc", "at").withColumn("c", F.least(F.lit(span), F.coalesce(nxt - F.col("at"), F.lit(span))))
    covered = covered.groupBy("doc").agg(F.sum("c").alias("part"))
    records = members(documents, doc_id, text, span, met)
    copies = records.groupBy("doc").agg((F.count("*") > 1).alias("copied"))
    shared = records.join(copies, "doc").join(covered, "doc", "left").select("doc_id", "copied", "part")
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"))
    out = docs.join(shared, "doc_id", "left")
    shared = F.when(F.coalesce("copied", F.lit(False)), F.col("n_chars")).otherwise(F.coalesce("part", F.lit(0)))
    out = out.select("doc_id", "n_chars", shared.cast("long").alias("shared_chars"))
    return out.withColumn("share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))
