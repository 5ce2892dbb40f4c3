"""Texts that look alike made equal, with the corpus's own vocabulary.

The plain words of all texts form the vocabulary. A word with odd characters is looked up in it: a trie of vocabulary
words is traversed by a weighted edit automaton, in which look-alike characters, composed for combined letters and
ignorable characters cost nothing and every other edit costs 1 (with a budget of 0 by default). Of the words reached
at the least cost the most frequent one is the canonical spelling; a word that reaches none is normalised by table.

The vocabulary is spread over buckets by a hash of the looks, which words that reach each other at no cost have in
common, so each trie holds one bucket only; there are more buckets the larger the vocabulary is. With a budget, words
also stand under their looks with up to as many letters left out: words within the budget have one of these in common.
Words are looked up once each, however often they occur.

A word wholly in another script is only replaced if the vocabulary has a word that looks the same and it has two
letters or more: otherwise it stands for itself. Null and empty texts stay as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.charforms import _FOREIGN, _LATIN, _TABLE, IGNORABLE, LOOKALIKE, ODD, ODD_JAVA, WORD, looks_odd, plain_char, plain_word
from ..sources.stored import stored

#: Buckets at least, and vocabulary words a bucket at most, on average.
BUCKETS, WORDS_A_BUCKET = 256, 20_000
_END = ""


def looks(word: str) -> str:
    """The plain Latin look of a word: words that reach each other at no cost have the same."""
    word = unicodedata.normalize("NFC", word.translate(_TABLE))
    return unicodedata.normalize("NFC", "".join(LOOKALIKE.get(c, c) for c in word))


def near_looks(look: str, budget: int) -> list[str]:
    """The looks with up to ``budget`` letters left out, each once."""
    out = level = {look}
    for _ in range(budget):
        level = {w[:k] + w[k + 1 :] for w in level for k in range(len(w))}
        out = out | level
    return sorted(out)


def trie_of(words: list[tuple[str, int]]) -> dict:
    root: dict = {}
    for word, n in words:
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[_END] = (n, word)
    return root


class LookAutomaton:
    """Matches one odd word against a trie; see the module's text for the costs."""

    def __init__(self, word: str, budget: int = 0) -> None:
        self.word, self.budget = word, budget

    def steps(self, i: int) -> list[tuple[str, int]]:
        """(letters, next position): what the trie may read for the characters from position i on, at no cost."""
        word, ch = self.word, self.word[i]
        if IGNORABLE.match(ch):
            return [("", i + 1)]
        out = [(ch, i + 1)]
        if (plain := plain_char(ch)) != ch:
            out.append((plain, i + 1))
        if (look := LOOKALIKE.get(plain)) is not None:
            out.append((look, i + 1))
        # a letter and the combining marks after it (ignorables between them) read as one composed letter
        j, marks = i + 1, ""
        while j < len(word) and (unicodedata.combining(word[j]) or IGNORABLE.match(word[j])):
            if unicodedata.combining(word[j]):
                marks += word[j]
            j += 1
            if marks:
                out += [(c, j) for base in {ch, plain, look} - {None} if len(c := unicodedata.normalize("NFC", base + marks)) == 1]
        return out

    def matches(self, trie: dict) -> list[tuple[int, int, str]]:
        """(cost, -frequency, word) of every vocabulary word within the budget, the least cost of each."""
        best: dict[str, tuple[int, int, str]] = {}
        todo = [(trie, 0, 0)]
        seen: dict[tuple[int, int], int] = {}
        while todo:
            node, i, cost = todo.pop()
            if seen.get((id(node), i), self.budget + 1) <= cost:
                continue
            seen[(id(node), i)] = cost
            if i == len(self.word):
                if _END in node:
                    n, word = node[_END]
                    if word not in best or best[word][0] > cost:
                        best[word] = (cost, -n, word)
            else:
                for letters, j in self.steps(i):
                    at = node
                    for ch in letters:
                        at = at.get(ch) if at is not None else None
                    if at is not None:
                        todo.append((at, j, cost))
            if cost < self.budget:
                if i < len(self.word):
                    todo.append((node, i + 1, cost + 1))
                for ch, at in node.items():
                    if ch != _END:
                        todo.append((at, i, cost + 1))
                        if i < len(self.word):
                            todo.append((at, i + 1, cost + 1))
        return sorted(best.values())


def canonical(word: str, trie: dict, budget: int = 0) -> tuple[int, int, str]:
    """(cost, frequency, spelling): the canonical spelling of an odd word; without one, its plain form at more than the budget."""
    composed = unicodedata.normalize("NFC", word.translate(_TABLE))
    foreign = _FOREIGN.search(composed) and not _LATIN.search(composed)
    if foreign and sum(c.isalpha() for c in composed) < 2:
        return 0, 0, composed
    found = LookAutomaton(word, budget).matches(trie)
    return (found[0][0], -found[0][1], found[0][2]) if found else (budget + 1, 0, plain_word(composed))


def law_texts(catalog: DataFrame, fassung: DataFrame) -> DataFrame:
    """tab, rec_id, field_name, text of law_catalog_merged.name, fassung.heading and fassung.body, in one scan each."""
    kinds = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("heading", "body"))))
    of_sections = fassung.select(F.lit("fassung").alias("tab"), "rec_id", kinds.alias("f")).select("tab", "rec_id", "f.*")
    of_laws = catalog.select(F.lit("law_catalog_merged").alias("tab"), F.col("cat_id").alias("rec_id"), F.lit("name").alias("field_name"), F.col("name").alias("text"))
    return of_laws.unionByName(of_sections).where(F.col("text").isNotNull())


def odd_words(texts: DataFrame) -> DataFrame:
    """tab, rec_id, field_name, word: the odd words of every odd text, each once a text.

    Besides, a row with a null word for a text with odd characters outside words, e.g. special spaces.
    """
    schema = pa.schema([("tab", pa.string()), ("rec_id", pa.int64()), ("field_name", pa.string()), ("word", pa.string()), ("looks", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tab, rec, field, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = {w for w in WORD.findall(text) if ODD.search(w)}
                rows += [(tab, rec, field, w, looks(w)) for w in words]
                outside = WORD.sub("", text)
                if unicodedata.normalize("NFC", outside.translate(_TABLE)) != outside:
                    rows.append((tab, rec, field, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema, strict=True)], schema=schema)

    odd = texts.where(looks_odd(F.col("text"))).select("tab", F.col("rec_id").cast("long"), "field_name", "text")
    return odd.mapInArrow(run, "tab string, rec_id long, field_name string, word string, looks string")


def spellings(texts: DataFrame, occurrences: DataFrame, budget: int = 0) -> DataFrame:
    """word, canonical for every odd word of ``occurrences`` (from ``odd_words``), by the vocabulary of ``texts``."""
    plain = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{M}\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}\x{34f}]+"), F.lit(0))).alias("word")).where(~F.col("word").rlike(ODD_JAVA))
    vocabulary = stored(plain.groupBy("word").agg(F.count("*").alias("n")))
    buckets = max(BUCKETS, vocabulary.count() // WORDS_A_BUCKET)
    bucket = F.pmod(F.xxhash64("looks"), F.lit(buckets)).cast("int").alias("bucket")
    if budget:

        @F.pandas_udf(ArrayType(StringType()))
        def around(looks_: pd.Series) -> pd.Series:
            return looks_.map(lambda w: near_looks(w, budget))

        bucket = F.explode(F.array_distinct(F.transform(around("looks"), lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int")))).alias("bucket")
    entries = vocabulary.select(F.lit(0).alias("odd"), "word", F.col("word").alias("looks"), "n").select("odd", "word", "n", bucket)
    asked = occurrences.where("word is not null").select("word", "looks").distinct().select(F.lit(1).alias("odd"), "word", F.lit(0).cast("long").alias("n"), bucket)
    schema = pa.schema([("word", pa.string()), ("cost", pa.int32()), ("n", pa.int64()), ("canonical", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, trie = -1, [], None
        for batch in batches:
            out = []
            for odd, word, n, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != at:
                    at, words, trie = b, [], None
                if not odd:
                    words.append((word, n))
                else:
                    if trie is None:
                        trie, words = trie_of(words), []
                    out.append((word, *canonical(word, trie, budget)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t.type) for k, t in enumerate(schema)], schema=schema)

    # only buckets that something is looked up in are moved
    entries = entries.join(asked.select("bucket").distinct(), "bucket", "left_semi").select("odd", "word", "n", "bucket")
    found = entries.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "odd").mapInArrow(run, "word string, cost int, n long, canonical string")
    # a word under several looks was looked up in several buckets
    return found.groupBy("word").agg(F.min_by("canonical", F.struct("cost", -F.col("n"), "canonical")).alias("canonical")) if budget else found.select("word", "canonical")


def inconsistent(texts: DataFrame) -> DataFrame:
    """tab, rec_id, field_name of every text that is not in the consistent form."""
    found = stored(odd_words(texts))
    changed = spellings(texts, found).where("word != canonical").select("word")
    words = found.join(changed, "word", "left_semi").select("tab", "rec_id", "field_name")
    return words.unionByName(found.where("word is null").select("tab", "rec_id", "field_name")).distinct()


def normalized(texts: DataFrame) -> DataFrame:
    """tab, rec_id, field_name, text of every text that is not in the consistent form, in that form."""
    found = stored(odd_words(texts))
    by_word = spellings(texts, found)
    keys = ["tab", "rec_id", "field_name"]
    # a text's own odd words, so no more than the text holds
    swaps = found.join(by_word, "word", "left").groupBy(*keys).agg(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "canonical"))).alias("swaps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, swaps_ in zip(batch[3].to_pylist(), batch[4].to_pylist(), strict=True):
                to = {x["word"]: x["canonical"] for x in swaps_}
                parts, last = [], 0
                for m in WORD.finditer(text):
                    parts += [text[last : m.start()].translate(_TABLE), to.get(m[0], m[0])]
                    last = m.end()
                out.append("".join([*parts, text[last:].translate(_TABLE)]))
            changed = pa.array([a != b for a, b in zip(out, batch[3].to_pylist(), strict=True)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.string())], names=[*keys, "text"]).filter(changed)

    odd = texts.where(looks_odd(F.col("text"))).select("tab", F.col("rec_id").cast("long"), "field_name", "text")
    return odd.join(swaps, keys).select(*keys, "text", "swaps").mapInArrow(run, "tab string, rec_id long, field_name string, text string")
