import random
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.llm import bpe, consensus, linkage, mixing, spans, spelling


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- encoding


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(remembered=50)


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t  abLd'sre019.,ü§😀\u0301\u4e2d")), max_size=40))
def test_encode_like_reference(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_encode_any(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_encode_long(encoder, reference):
    text = "ab" * 30_000 + " " + "=" * 5_000
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_pair_tree():
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 33):
        values = [rng.randrange(9) for _ in range(n)]
        tree = bpe.PairTree(list(values))
        for _ in range(60 if n else 0):
            values[i] = (tree.update(i := rng.randrange(n), v := rng.randrange(9)), v)[1]
            assert tree.leftmost() == values.index(min(values))


def test_encode_frame(spark, reference):
    texts = [None, "", " ", "Die Gebühr", "Die Gebühr", "<|endoftext|>"]
    df = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(texts)], "doc_id long, text string, ids string")
    assert {r.doc_id: r.ids for r in bpe.encode(df).collect()} == {k: reference.encode_ordinary(x or "") for k, x in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in bpe.count_tokens(df, "doc_id").collect()} == {k: len(reference.encode_ordinary(x or "")) for k, x in enumerate(texts)}
    assert bpe.encode(df.limit(0)).count() == 0


# --- spans


def brute_spans(docs, span):
    held = defaultdict(set)
    for i, x in docs:
        for k in range(len(x or "") - span + 1):
            held[x[k : k + span]].add(i)
    pairs = {(a, b) for v in held.values() for a in v for b in v if a < b}
    cover = {}
    for i, x in docs:
        mark = [False] * len(x or "")
        for k in range(len(mark) - span + 1):
            if len(held[x[k : k + span]]) > 1:
                mark[k : k + span] = [True] * span
        cover[i] = sum(mark)
    return pairs, cover


@pytest.mark.parametrize("seed", range(4))
def test_spans(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("ab😀 c") for _ in range(n))
    shared = [word(rng.randint(15, 60)) for _ in range(5)]
    docs = [(k, "".join(rng.choice([word(rng.randint(0, 25)), rng.choice(shared)[: rng.randint(10, 60)]]) for _ in range(rng.randint(0, 6)))) for k in range(40)]
    docs += [(40, None), (41, ""), (42, "a" * 500), (43, "xa" * 3 + "a" * 300), (44, "ab" * 200), (45, "ba" * 150), (46, docs[3][1]), (47, docs[3][1]), (48, word(70))]
    docs += [(49, docs[48][1]), (50, docs[48][1]), (51, "short"), (52, "short")]
    pairs, cover = brute_spans(docs, 20)
    df = spark.createDataFrame([(i, x, 1) for i, x in docs], "doc_id long, text string, at int")
    cand = spans.candidate_spans(df, span=20, gram=11)
    found = rows_of(spans.record_pairs(spans.text_pairs(cand), spans.members(df, span=20)))
    assert set(found) == pairs and len(found) == len(pairs)
    share = {r.doc_id: (r.shared_chars, r.n_chars) for r in spans.shared_share(df, spans.shared_spans(cand), span=20).collect()}
    assert share == {i: (cover[i], len(x or "")) for i, x in docs}
    assert spans.text_pairs(spans.candidate_spans(df.limit(0))).count() == 0
    texts = dict(docs)
    classes = {r.doc_id: r for r in spans.linked_classes(spans.text_pairs(cand), spans.members(df, span=20)).collect()}
    assert set(classes) == {i for i, x in docs if len(x or "") >= 20}
    for i, r in classes.items():
        others = {texts[b if a == i else a] for a, b in pairs if i in (a, b)} - {texts[i]}
        same = [k for k, x in docs if x == texts[i]]
        assert (r.class_id, r.n_copies, r.n_links) == (min(same), len(same), len(others))


def test_texts_of_one_hash(spark, monkeypatch):
    """Texts whose hashes meet are told apart."""
    docs = [(1, "a" * 30 + "x" * 25), (2, "b" * 30 + "y" * 25), (3, "c" * 5 + "x" * 25), (4, "d" * 5 + "y" * 25)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    met = df.where("doc_id <= 2").select(F.xxhash64("text").alias("doc"), F.lit(True).alias("met"))
    cand = spans.candidate_spans(df, span=20, gram=11, met=met)
    assert sorted(rows_of(spans.record_pairs(spans.text_pairs(cand), spans.members(df, span=20, met=met)))) == [(1, 3), (2, 4)]
    assert spans.met_hashes(df, span=20).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=40), st.integers(1, 8))
def test_compact_windows(values, width):
    h = np.array(values, np.uint64)
    found = spans.compact_windows(h, width)
    for s in range(len(h) - width + 1):
        c = s + int(h[s : s + width].argmin())
        assert sum(p == c and a <= s and s + width - 1 <= b for a, p, b in found) == 1


def test_windows_of_one_character_are_linear():
    assert len(spans.compact_windows(np.zeros(200_000, np.uint64), 101)) <= 200_000


# --- mixing


def test_route():
    size, flows = mixing.route({("a",): 100, ("b",): 1000}, {"a": 0.5, "b": 0.5}, {"a": 3, "b": 1})
    assert size in (600, 601) and flows[("a",), "a"] == 300
    size, flows = mixing.route({("a",): 100, ("b",): 1000, ("a", "b"): 300}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 1})
    assert size in (800, 801) and flows[("a", "b"), "a"] == 300
    assert mixing.route({}, {"a": 1.0}, {"a": 1})[0] == 0
    assert mixing.route({("a",): 100}, {"a": 1.0}, {"a": 9}, total=250)[0] == 100  # never more than the corpus


def test_mix(spark):
    rng = random.Random(3)
    docs = [(k, rng.choice([["a"], ["b"], ["b"], ["b"], ["a", "b"], ["x"], None, []]), rng.choice([0, 3, 10, 25])) for k in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, sources array<string>, n_tokens long").withColumn("bucket", F.lit("clash"))
    w = spark.createDataFrame([("a", 0.6, 3), ("b", 0.4, 2), ("none", 0.0, None)], "source string, target_share double, max_repeats int")
    got = rows_of(mixing.mix(df, w))
    used, by, caps = Counter(), Counter(), {"a": 3, "b": 2}
    member = {k: s for k, s, _ in docs}
    for doc, source, times, n in got:
        assert source in member[doc] and 0 < times <= caps[source] and n > 0
        used[doc] += times
        by[source] += times * n
    assert all(n <= max(caps[s] for s in member[d]) for d, n in used.items())
    assert abs(by["a"] / (by["a"] + by["b"]) - 0.6) < 0.01
    assert sorted(got) == sorted(rows_of(mixing.mix(df, w)))
    report = {r.source: r for r in mixing.shares(mixing.mix(df, w), w).collect()}
    assert set(report) == {"a", "b", "none"} and report["a"].n_tokens == by["a"] and report["none"].n_tokens == 0
    assert mixing.mix(df.limit(0), w).count() == 0 and mixing.mix(df, w.limit(0)).count() == 0


# --- spelling


def test_automaton():
    trie = spelling.trie_of([("so", 5), ("höhe", 2), ("öffnung", 1), ("hohe", 9)])
    assert spelling.canonical("ѕо", trie)[2] == "so"  # wholly Cyrillic, but a word of the vocabulary
    assert spelling.canonical("hо\u0308he", trie)[2] == "höhe"
    assert spelling.canonical("o\N{COMBINING DIAERESIS}\u200bﬀnung", trie)[2] == "öffnung"
    assert spelling.canonical("Палата", trie)[2] == "Палата" and spelling.canonical("α", trie)[2] == "α"
    assert spelling.canonical("Ѕalz", trie)[2] == "Salz"  # by table
    assert [w for _, _, w in spelling.LookAutomaton("hоhе", 1).matches(trie)] == ["hohe", "höhe"]


def test_spelling(spark):
    texts = [("t", 1, "f", "Die Höhe ist so"), ("t", 2, "f", "Die Ho\N{COMBINING DIAERESIS}he"), ("t", 3, "f", "Die ⅢHöhe"), ("t", 4, "f", "α-Strahler m²"), ("t", 5, "f", "ѕо"), ("t", 6, "f", ""), ("t", 7, "f", "x\N{NO-BREAK SPACE}y"), ("t", 8, "f", "x  y"), ("t", 8, "g", "Sa\u00adlz"), ("t", 2, "f", "Die Ho\N{COMBINING DIAERESIS}he")]
    df = spark.createDataFrame(texts, "tab string, rec_id long, field_name string, text string").withColumn("word", F.lit(1))
    assert sorted(rows_of(spelling.inconsistent(df))) == [("t", 2, "f"), ("t", 3, "f"), ("t", 5, "f"), ("t", 7, "f"), ("t", 8, "g")]
    new = {(r.rec_id, r.field_name): r.text for r in spelling.normalized(df).collect()}
    assert new == {(2, "f"): "Die Höhe", (3, "f"): "Die IIIHöhe", (5, "f"): "so", (7, "f"): "x y", (8, "g"): "Salz"}
    assert spelling.inconsistent(df.limit(0)).count() == 0


def test_spelling_with_edits(spark):
    """An odd word that is misspelt as well, at its beginning or end, finds its word within the budget."""
    plain = [("t", k, "f", w) for k, w in enumerate(["Bewilligung", "Bewilligung", "Verordnung", "Haftung"])]
    odd = [("t", 10, "f", "Bwilligu\u00adng"), ("t", 11, "f", "Vеrordnun"), ("t", 12, "f", "Hаftungen")]  # Cyrillic letters
    df = spark.createDataFrame(plain + odd, "tab string, rec_id long, field_name string, text string")
    words = spelling.odd_words(df)
    assert {r.word: r.canonical for r in spelling.spellings(df, words).collect()} == {"Bwilligu\u00adng": "Bwilligung", "Vеrordnun": "Verordnun", "Hаftungen": "Haftungen"}
    assert {r.word: r.canonical for r in spelling.spellings(df, words, budget=1).collect()} == {"Bwilligu\u00adng": "Bewilligung", "Vеrordnun": "Verordnung", "Hаftungen": "Haftungen"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=12), st.text("abc", min_size=1, max_size=6), st.integers(0, 2))
def test_looks_in_common(words, asked, budget):
    """Words within the budget have one of their shortened looks in common, so no bucket hides them."""
    mine = set(spelling.near_looks(asked, budget))
    for cost, _, word in spelling.LookAutomaton(asked, budget).matches(spelling.trie_of([(w, 1) for w in words])):
        assert cost <= budget and mine & set(spelling.near_looks(word, budget))


# --- consensus


FULL = "§ 1. (1) Die Gebühr beträgt zehn Euro im Jahr.\n1. für Erwachsene der Gemeinde,\n2. für Kinder der Gemeinde,\nDer Betrag ist am Ersten fällig."


def test_survivors(spark):
    at = [datetime(2020, 1, k) for k in range(1, 10)]
    rows = [
        (1, "g", "d1", "§ 1", "Text", FULL, "b", at[3]), (2, "g", "d1", "§_1;", "Gebühren", FULL[:40], "a", at[5]), (3, "g", "d1", "§_1", "Höhe", FULL.replace(" ", "\N{NO-BREAK SPACE}"), "b", at[1]),
        (4, "g", "d1", "§_2", None, None, "a", None), (5, "g", "d1", "§_2", "(Anm.: x)", "", None, None), (6, "g", "d1", "§_3", "Ziel", FULL, "a", None), (7, None, "d1", "§_3", "Ziel", FULL, "a", None),
    ]
    cols = "rec_id long, gsn string, fassung_vom string, section_id string, heading string, body string, quelle string, geladen_am timestamp_ntz"
    df = spark.createDataFrame(rows, cols).withColumn("rang", F.lit("clash"))
    q = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "quelle string, rang int")
    got = {(r.section, r.body_rec_id, r.heading_rec_id) for r in consensus.survivors(df, q).collect()}
    assert got == {("§_1", 1, 2), ("§_2", 4, 4)}
    assert consensus.survivors(df.limit(0), q).count() == 0


# --- linkage


def test_kinds():
    assert linkage.split_kind("zollüberwachungskundmachung")[1] == "kundmachung"
    for word, stem, kind in (("rohrregisterg", "rohrregister", "gesetz"), ("dorflenkungskdm.", "dorflenkungs", "kundmachung"), ("talvorsorgevdg.", "talvorsorge", "verordnung"), ("gartenvorsorgeverordnugn", "gartenvorsorge", "verordnung"), ("orgelstat.", "orgel", "statut"), ("wald", "wald", "")):
        assert linkage.split_kind(word) == (stem, kind)


def test_edits():
    assert linkage.edits("abcd", "abdc", 2) == 1 and linkage.edits("abcd", "abc", 2) == 1 and linkage.edits("abcd", "xyz", 1) == 2


def test_em():
    """Near misses in the second attribute are told from matches, whatever else agrees."""
    patterns = np.array([[1, 1, 1], [1, 1, -1], [0, 0, 0], [0, 1, 0], [1, 0, 0], [1, 0, -1]])
    chance = np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0]])
    odds = linkage.expectation_maximisation(patterns, np.array([50.0, 10, 40, 5, 8, 4]), chance, np.array([900.0, 50, 50]), [(0, 0), (1, 0)])
    assert odds[0] > 5 and odds[1] > 2 and odds[2:].max() < 0


def test_confidence_is_calibrated():
    """Drawn pairs with known truth: in each band of confidence about as many are matches as it says."""
    rng = np.random.default_rng(5)
    n = 200_000
    kind = rng.choice(4, n, p=[0.2, 0.2, 0.1, 0.5])  # match, another kind, another year, by chance
    chances = {0: (0.97, 1.0, 1.0, 0.85, 0.8), 1: (0.97, 0.0, 1.0, 0.1, 0.1), 2: (0.97, 1.0, 0.0, 0.6, 0.1), 3: (0.0, 0.5, 0.3, 0.05, 0.02)}
    agree = rng.random((n, 5)) < np.array([chances[k] for k in range(4)])[kind]
    levels = np.where(rng.random((n, 5)) < [0.0, 0.02, 0.4, 0.3, 0.4], -1, agree.astype(int))
    levels[kind == 2, 2] = 0  # a near miss shows what it misses
    patterns, at, counts = np.unique(levels, axis=0, return_inverse=True, return_counts=True)
    by_chance = np.unique(levels[kind == 3], axis=0, return_counts=True)
    odds = linkage.expectation_maximisation(patterns, counts.astype(float), by_chance[0], by_chance[1].astype(float), [(0, 0), (1, 0), (2, 0)])
    p = (1 / (1 + np.exp(-odds)))[at.ravel()]
    for low, high, error in ((0, 0.05, 0.01), (0.05, 0.5, 0.2), (0.5, 0.95, 0.2), (0.95, 1.01, 0.06)):
        band = (p >= low) & (p < high)
        assert band.sum() < 500 or abs((kind[band] == 0).mean() - p[band].mean()) < error
    linked = p >= linkage.CONFIDENT
    assert (kind[linked] == 0).mean() > 0.95 and linked[kind == 0].mean() > 0.9


def test_link(spark):
    mains, scopes = ["Zollkontroll", "Wasserschutz", "Mühlenvergabe", "Theatersperr", "Luftquoten", "Parkumlagen"], ["private Betriebe", "ländliche Gebiete", "mobile Anlagen", "alpine Haushalte"]
    laws = [(f"{m}gesetz über {s}", f"{m[:3]}G-{s[0]}{k}", f"BGBl. Nr. {100 + k}/19{60 + k % 40}") for k, (m, s) in enumerate((m, s) for m in mains for s in scopes)]
    cat = [(k, f"g{k}", n, a, "BG", r, 1) for k, (n, a, r) in enumerate(laws)]
    cat += [(100, "g100", f"Bundesgesetz, mit dem das {laws[0][0]} geändert wird", None, "BG", None, 1), (101, "g3", laws[3][0], None, None, None, 1), (102, None, laws[5][0], None, None, None, 1), (103, "g103", None, None, None, None, 1)]
    entries = [(1, "Betriebe, private; Zollkontrollges.", None, "BG", None), (2, "BG WASSERSHCUTZG BETR. LÄNDLICHE GEBIETE", "wasg-l5", None, None), (3, "mobile Anl. (Mühlenvergabegesetz)", None, "BG", "110/1970"), (4, "Zollkontrollgesetz 1999 über kleinere Märkte", None, None, None), (5, None, None, None, None), (6, "", " ", "", "x"), (7, "Höhlenwartungsgesetz – private Betriebe", None, "BG", None), (8, "alpine Haushalte (Zollkontrollgesetz)", None, None, None)]
    c = spark.createDataFrame(cat, "cat_id long, gsn string, name string, abbrev string, typ string, kundmachungsorgan string, keys int")
    e = spark.createDataFrame(entries, "entry_id long, index_name string, index_abbrev string, index_typ string, index_fundstelle string").withColumn("stem", F.lit(1))
    got = {r.entry_id: r.gsn for r in linkage.link(e, c).collect()}
    assert got == {1: "g0", 2: "g5", 3: "g10", 8: "g3"}
    # a hot block is split without losing what agrees further
    old, linkage.split_hot.__defaults__ = linkage.split_hot.__defaults__, (1,)
    try:
        assert {r.entry_id: r.gsn for r in linkage.link(e, c).collect()} == got
    finally:
        linkage.split_hot.__defaults__ = old
    assert linkage.link(e.limit(0), c).count() == 0 and linkage.link(e, c.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1, 10, 100, 10_000])
def test_hot_block_keeps_all_pairs(spark, most):
    left = [(i, 7 if i < 40 else i) for i in range(45)]
    right = [(i, 7 if i < 30 else i + 12) for i in range(33)]
    attributes = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in linkage.FIELDS.split(", ")]
    e = spark.createDataFrame(left, "id long, key long").select(F.struct("id", *attributes).alias("e"), "key")
    c = spark.createDataFrame(right, "gsn long, key long").select(F.struct("gsn", *attributes).alias("c"), "key")
    x, y = linkage.split_hot(e, c, most)
    pairs = sorted(rows_of(x.join(y, "key").select("e.id", "c.gsn")))
    assert pairs == sorted((i, g) for i, a in left for g, b in right if a == b)


def test_link_in_hot_block(spark):
    """A misspelt name without abbreviation, gazette or year is linked however many pairs its block has."""
    mains, scopes = ["Zollkontroll", "Wasserschutz", "Mühlenvergabe", "Theatersperr", "Luftquoten", "Parkumlagen"], ["private Betriebe", "ländliche Gebiete", "mobile Anlagen", "alpine Haushalte"]
    cat = [(k, f"g{k}", f"{m}gesetz über {s}", None, "BG", None) for k, (m, s) in enumerate((m, s) for m in mains for s in scopes)]
    entries = [(k, n.replace("Wasserschutz", "Wassershcutz").replace("Luftquoten", "Luftqouten"), None, "BG", None) for k, _, n, *_ in cat]
    twice = [*cat, *((100 + k, *rest) for k, *rest in cat)]  # so that no block has a single pair
    c = spark.createDataFrame(twice, "cat_id long, gsn string, name string, abbrev string, typ string, kundmachungsorgan string")
    e = spark.createDataFrame(entries, "entry_id long, index_name string, index_abbrev string, index_typ string, index_fundstelle string")
    whole = {r.entry_id: r.gsn for r in linkage.link(e, c).collect()}
    assert whole == {k: f"g{k}" for k in range(len(cat))}
    old, linkage.split_hot.__defaults__ = linkage.split_hot.__defaults__, (1,)
    try:
        assert {r.entry_id: r.gsn for r in linkage.link(e, c).collect()} == whole
    finally:
        linkage.split_hot.__defaults__ = old
