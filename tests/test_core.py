import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.functions import law_text as t
from statuta.functions.charforms import consistent, consistent_form
from statuta.functions.integrity import broken_characters, cut_off, repeats
from statuta.functions.section_ids import regular_id
from statuta.functions.sequences import common_subsequence, edit_script
from statuta.functions.alignment import align, longest_common, tokens_of
from statuta.operators import duplicates, snapshot_diff
from statuta.operators.duplicates import cost, departures, kept_texts, with_damage
from statuta.operators.history import DeltaStore
from statuta.operators.shred import numbered_descendants, parent_label, shred_array_levels, shred_xml, xml_nodes
from statuta.operators.snapshot_diff import changes
from statuta.plans import laws as laws_plans


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "regular"),
    [("§_5a", "§_5a"), ("§._6._Paragraph_6,", "§_6"), (" §_2", "§_2"), ("§ 4", "§_4"), ("§.8", "§_8"), ("§  10g.", "§_10g"), ("§_18;", "§_18"), ("ANLAGE_1", "Anlage_1"), ("Anlage._1", "Anlage_1"), ("Artikel 2.", "Art_2"), ("Art._3._Paragraph_3,", "Art_3"), ("Art_II_§._9._Paragraph_9,", "Art_II_§_9"), ("Art_I_§_1,", "Art_I_§_1"), ("Section-77", "Section-77"), ("§\u00a05", "§_5"), ("", None), (None, None), ("Vorwort", "Vorwort")],
)
def test_regular_id(spark, raw, regular):
    assert spark.createDataFrame([(raw,)], "s string").select(regular_id(F.col("s")).alias("x")).first().x == regular


@pytest.mark.parametrize(
    ("odd", "plain"),
    [("Нöсhѕtwerte", "Höchstwerte"), ("α-Strahler", "α-Strahler"), ("Νερόμυλος", "Νερόμυλος"), ("Ⅱ. Abschnitt", "II. Abschnitt"), ("öﬀentlich", "öffentlich"), ("u\u0308ber", "über"), ("Fris\u200cten\u00ad", "Fristen"), ("a\u00a0b", "a b"), ("m²", "m²"), ("Ａｂ３", "Ab3"), ("и\u0306", "й"), ("x‑y", "x-y"), ("", ""), (None, None)],
)
def test_consistent(spark, odd, plain):
    assert consistent(odd) == plain
    assert spark.createDataFrame([(odd,)], "s string").select(consistent_form(F.col("s")).alias("x")).first().x == plain


def test_odd_characters(spark):
    """One pass over a text finds just the characters of the table, in very long texts as well."""
    from statuta.functions.charforms import ODD, looks_odd

    texts = [chr(o) + "x" for r in (range(1, 0x3100), range(0xA720, 0xA740), range(0xFB00, 0x10000), range(0x1D3F0, 0x1D810)) for o in r] + ["a–" * 1_000_000, "a–" * 500_000 + "\u200b", "", "\n\n"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    assert {r.k for r in df.where(looks_odd(F.col("t"))).collect()} == {k for k, t in enumerate(texts) if ODD.search(t)}


def test_integrity():
    assert broken_characters("HÃ¶he") and broken_characters("f&uuml;r") and broken_characters("� 3") and not broken_characters("Höhe & Tiefe â la carte")
    assert cut_off("Die Gebühr betr") and not cut_off("a) die Steuer und") and not cut_off("Ende.")
    x = "§ 1. Die Gebühr beträgt mindestens zehn Euro im Jahr."
    assert repeats(x + "\n" + x) and not repeats(x)


def test_xml_nodes():
    text = '<r xmlns="urn:x"><listelem ct="text">a<b/>t<listelem ct="text">in</listelem></listelem><listelem ct="x"/><!-- c --><listelem ct="text"><![CDATA[<z>]]></listelem>tail</r>'
    nodes = xml_nodes(text)
    assert [(n[0], n[2]) for n in nodes] == [("1", "r"), ("1.1", "listelem"), ("1.1.1", "b"), ("1.1.2", "listelem"), ("1.2", "listelem"), ("1.3", "listelem")]
    assert nodes[1][4] == "atin" and nodes[2][5] == "t" and nodes[5][4:] == ("<z>", "tail")
    assert xml_nodes("<a><b></a>") is None and xml_nodes("") is None and xml_nodes("\x00") is None


def test_shred(spark):
    rows = [(1, '<n><listelem ct="text">a<l><listelem ct="text"/><listelem ct="y"><listelem ct="text"/></listelem></l></listelem></n>'), (2, "<broken"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id long, x string").withColumn("dewey", F.lit("clash"))
    got = sorted((r.rec_id, r.parent_no, r.child_no) for r in numbered_descendants(df, "id", "x", "listelem", "ct", "text").collect())
    assert got == [(1, 0, 1), (1, 1, 2), (1, 1, 3)]
    nodes = shred_xml(df, "id", "x").collect()
    assert {n.rec_id for n in nodes} == {1} and all(n.parent_dewey == n.dewey.rpartition(".")[0] for n in nodes)


def test_shred_arrays(spark):
    item = "struct<symbol:string,text:string>"
    df = spark.createDataFrame([(1, [{"type": "list", "items": [("a", "x"), None]}, None, {"type": "text", "items": []}]), (2, None), (3, [])], f"id long, blocks array<struct<type:string,items:array<{item}>>>")
    blocks, items = shred_array_levels(df, "id", ["blocks", "items"])
    assert [(r.rec_id, r.dewey, r.type) for r in blocks.orderBy("dewey").collect()] == [(1, "1", "list"), (1, "2", None), (1, "3", "text")]
    assert [(r.dewey, r.parent_dewey, r.no, r.symbol) for r in items.withColumn("p", parent_label(F.col("dewey"))).where("p = parent_dewey").orderBy("dewey").collect()] == [("1.1", "1", 1, "a"), ("1.2", "1", 2, None)]


def snapshots(seed, laws=3, dates=40, sections=30):
    rng = random.Random(seed)
    rows = []
    for law in range(laws):
        state = {}
        for k in range(rng.randint(1, dates)):
            for _ in range(rng.randint(0, 4)):
                s = rng.randrange(sections)
                if rng.random() < 0.3:
                    state.pop(s, None)
                else:
                    state[s] = rng.choice(["a", "b", "c", None])
            rows += [(f"L{law}", f"{1990 + k}-01-01", f"s{s}", v) for s, v in state.items()]
    return rows


def brute(rows):
    laws = defaultdict(lambda: defaultdict(dict))
    for law, date, s, v in rows:
        laws[law][date][s] = (v,)
    runs, diffs = set(), set()
    for law, days in laws.items():
        dates = sorted(days)
        for s in {s for x in days.values() for s in x}:
            start = None
            for d in [*dates, None]:
                v = days[d].get(s) if d else None
                if start and v != start[1]:
                    runs.add((law, s, start[1][0], start[0], d or "9999-12-31"))
                    start = None
                if v and not start:
                    start = (d, v)
        for a, b in zip(dates, dates[1:], strict=False):
            for s in days[a].keys() | days[b].keys():
                x, y = days[a].get(s), days[b].get(s)
                if x != y:
                    diffs.add((law, b, s, "added" if x is None else "removed" if y is None else "changed"))
    return runs, diffs


@pytest.mark.parametrize("every", [1, 4, 16])
def test_history_and_changes(spark, every):
    rows = snapshots(every)
    runs, diffs = brute(rows)
    noise = [(None, "2000-01-01", "s1", "a"), ("L0", None, "s1", "a"), ("L0", "1990-01-01", None, "a"), *rows[:5]]
    df = spark.createDataFrame(rows + noise, "law string, date string, sec string, v string").withColumn("seq", F.lit(1)).withColumn("epoch", F.lit("x"))
    store = DeltaStore.build(df, "law", "sec", "v", "date", every)
    assert sorted(map(repr, map(tuple, store.validity().collect()))) == sorted(map(repr, runs))
    assert {tuple(r) for r in changes(df, "law", "date", "sec", "v").collect()} == diffs
    dates = {law: sorted({d for x, d, _, _ in rows if x == law}) for law in {r[0] for r in rows}}
    last = {(law, s): v for law, d, s, v in rows if len(dates[law]) > 5 and d == dates[law][5]}
    assert {(r.law, r.sec): r.v for r in store.as_of(5).collect()} == last


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 3), st.data())
def test_differing_leaves(depth, data):
    n = snapshot_diff.FAN**depth
    sides = [{k: (hash((k, v := data.draw(st.integers(0, 2)))), hash((v, k, 1))) for k in data.draw(st.sets(st.integers(0, n - 1)))} for _ in range(2)]
    packed = [tuple(np.array(x, np.int64) for x in (sorted(t), [t[k][0] for k in sorted(t)], [t[k][1] for k in sorted(t)])) for t in sides]
    got = snapshot_diff.differing_leaves(depth, *packed)
    assert sorted(got) == [k for k in range(n) if sides[0].get(k, (0, 0)) != sides[1].get(k, (0, 0))]


def test_changes_of_large_snapshots(spark, monkeypatch):
    """Snapshots of more leaves than one packed row holds."""
    monkeypatch.setattr(snapshot_diff, "PACKED", 1)
    rows = [("a", d, f"s{k}", str(k // 7 if d == "d1" or k % 50 else -k)) for d in ("d1", "d2") for k in range(700) if (d, k % 90) != ("d2", 3)]
    df = spark.createDataFrame(rows, "law string, date string, sec string, v string")
    old, new = ({k: v for _, at, k, v in rows if at == d} for d in ("d1", "d2"))
    due = {(k, "removed" if k not in new else "changed") for k in old if old[k] != new.get(k)}
    assert {(r.sec, r.change_kind) for r in changes(df, "law", "date", "sec", "v").collect()} == due


def test_history_of_nothing(spark):
    df = spark.createDataFrame([], "law string, date string, sec string, v string")
    assert DeltaStore.build(df, "law", "sec", "v", "date").validity().count() == 0
    assert changes(df, "law", "date", "sec", "v").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_align(a, b):
    for pairs in (align(a, b), longest_common(a, b)):
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    assert len(longest_common(a, b)) == len(common_subsequence(a, b))


def test_align_large():
    rng = random.Random(1)
    a = [str(rng.randrange(5000)) for _ in range(3000)]
    b = a[:1000] + ["x"] * 50 + a[1000:2000] + a[2100:]
    assert len(align(a, b)) >= 2890
    # a long stretch of repeated lines without a unique token, changed in two distant places
    table = ["row", "of", "figures", "\n"] * 2000
    changed = table[:400] + ["other"] + table[401:7000] + ["other"] + table[7001:]
    assert len(align(table, changed)) == len(table) - 2


FULL = "§ 1. (1) Die Gebühr beträgt zehn Euro im Jahr.\n1. für Erwachsene der Gemeinde,\n2. für Kinder der Gemeinde,\nDer Betrag ist am Ersten fällig."


def test_departures():
    columns = tokens_of(FULL)
    rebuilt = {}
    for text in (FULL[:50], FULL.replace("1. für Erwachsene der Gemeinde,\n", ""), FULL.replace("zehn", "elf"), "", "x x x", FULL + " Und mehr mehr."):
        found = departures(columns, tokens_of(text))
        assert [x[0] for x in found] == sorted(x[0] for x in found)
        out = []
        by = defaultdict(list)
        for c, kind, token, _ in found:
            by[c].append((kind, token))
        for c in range(len(columns) + 1):
            out += [t for k, t in by[c] if k == duplicates.INSERTED]
            changed = [(k, t) for k, t in by[c] if k != duplicates.INSERTED]
            out += [t for k, t in changed if k == duplicates.OTHER] if changed else columns[c : c + 1]
        rebuilt[text] = out
    assert all(out == tokens_of(text) or tokens_of(text)[: len(out)] == out for text, out in rebuilt.items())
    assert departures(columns, columns) == [] and cost([], len(columns)) == 0.0
    # a number cut through is missing, not another number
    assert {k for _, k, _, _ in departures(tokens_of("mehr als 49.227 Meter im Jahr."), tokens_of("mehr als 49."))} == {duplicates.GAP}


def damages(spark, texts, sources=("a",)):
    """The damage of each text of one key; ``texts``: (text, whether it stands at another date as well)."""
    rows = [(k, "g", "d", "§_1", None, t, sources[k % len(sources)], None) for k, (t, _) in enumerate(texts)]
    rows += [(10_000 + k, "g", f"e{k}", "§_1", None, t, "a", None) for k, (t, elsewhere) in enumerate(texts) if elsewhere]
    q = spark.createDataFrame([("a", 1), ("b", 2)], "quelle string, rang int")
    return {r.rec_id: r.damage for r in with_damage(fassung(spark, rows), q).where("fassung_vom = 'd'").collect()}


def test_damage(spark):
    cut, item = FULL[:50], FULL.replace("1. für Erwachsene der Gemeinde,\n", "")
    texts = [FULL, cut, item, None, FULL.replace("ü", "�"), FULL + "\n" + FULL]
    got = damages(spark, [(x, False) for x in texts] + [(FULL.replace("zehn", "elf"), True)])
    assert [got[k] == 0 for k in range(7)] == [True, False, False, False, False, False, True]
    # a shorter text known from another date is a wording of its own
    got = damages(spark, [(FULL, False), (item, True)])
    assert got == {0: 0.0, 1: 0.0}
    assert set(damages(spark, [(None, False), ("", False)]).values()) == {0.0}  # one text: nothing to choose


def test_boilerplate(spark):
    """A line at an edge that the key's other texts lack, in several sections, is no part of the text."""
    line = "[Dokument wird geladen]"
    rows, texts = [], [FULL.replace("zehn", w) for w in ("elf", "zwölf")]
    for k, x in enumerate(texts):
        rows += [(2 * k, "g", "d", f"§_{k}", None, line + "\n" + x, "a", None), (2 * k + 1, "g", "d", f"§_{k}", None, x, "b", None)]
    q = spark.createDataFrame([("a", 1), ("b", 2)], "quelle string, rang int")
    assert sorted(r.rec_id for r in kept_texts(fassung(spark, rows), q).collect()) == [1, 3]


def fassung(spark, rows):
    cols = "rec_id long, gsn string, fassung_vom string, section_id string, heading string, body string, quelle string, geladen_am timestamp_ntz"
    return spark.createDataFrame(rows, cols)


def test_kept_texts(spark):
    from datetime import datetime

    at = [datetime(2020, 1, k) for k in range(1, 10)]
    full = "§ 1. Die Gebühr beträgt zehn Euro im Jahr."
    rows = [
        (1, "g", "d1", "§ 1", None, full[:20], "a", at[5]), (2, "g", "d1", "§_1;", None, full, "b", at[1]), (3, "g", "d1", "§_1", None, full.replace(" ", "\u00a0"), "b", at[2]),
        (4, "g", "d1", "§_2", None, None, "a", None), (5, None, "d1", "§_2", None, "x", "a", None), (6, "g", "d2", "§_1", None, full, None, None), (7, "g", "d2", "§_1", None, full, None, None),
    ]
    q = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "quelle string, rang int, text string")
    got = {(r.gsn, r.fassung_vom, r.section): r.rec_id for r in kept_texts(fassung(spark, rows), q).collect()}
    assert got == {("g", "d1", "§_1"): 3, ("g", "d1", "§_2"): 4, ("g", "d2", "§_1"): 6}
    assert kept_texts(fassung(spark, []), q).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9), st.booleans())
def test_edit_script(a, b, pair):
    script = edit_script(a, b, pair)
    assert [x for _, x, _ in script if x is not None] == a and [y for _, _, y in script if y is not None] == b
    common = common_subsequence(a, b)
    assert [x for op, x, _ in script if op == "context"] == common


def test_sort_key(spark):
    ids = ["§_2", "§_10", "§_10a", "Art_1", "Art_1_§_1", "Art_2", "Art_I", "Art_I_§_1", "Art_II", "Anlage_1", "Section-3", "other"]
    df = spark.createDataFrame([(x,) for x in random.Random(1).sample(ids, len(ids))], "s string")
    assert [r.s for r in df.orderBy(t.section_sort_key(F.col("s")), "s").collect()] == ids


@pytest.mark.parametrize(
    ("apa", "symbol", "heading", "body", "sid"),
    [("Art. 1 § 2a", "", "", "", "Art_1_§_2a"), ("Art. iv", "", "", "", "Art_iv"), ("§ 7", "", "", "", "§_7"), ("Anlage 3", "§ 9.", "", "", "§_9"), (None, None, "Anlage 2 Tarif", "", "Anlage_2"), ("", "", "", "§ 12. Text", "§_12"), ("", "", "", "Art. 3 Text", "Art_3")],
)
def test_derive_section_id(spark, apa, symbol, heading, body, sid):
    df = spark.createDataFrame([(apa, symbol, heading, body)], "a string, s string, h string, b string")
    assert df.select(t.derive_section_id(F.col("a"), F.col("s"), F.col("h"), F.col("b")).alias("x")).first().x == sid


def test_display(spark):
    show = lambda s, h: spark.createDataFrame([(s, h)], "s string, h string").select(t.display_heading(F.col("s"), F.col("h")).alias("x")).first().x
    assert show("§_5", None) == "§ 5." and show("§_5", "Gebühren") == "§ 5. Gebühren" and show("§_5", "§ 5 Gebühren") == "§ 5 Gebühren"
    assert show("Art_II_§_3", "Text") == "Art. II § 3." and show("Section-9", "(Anm.: x)") == "Section-9" and len(show("x" * 90, "")) == 80


def test_files(spark, tmp_path):
    from statuta.sources.files import read_map, read_sections, read_snapshots, write_versions

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "fassung.json").write_text(json.dumps({"§_1": {"section_id": "§_1", "heading": "h", "body": "b"}, "§_2": {"body": "c"}}))
    assert [(r.section_id, r.body) for r in read_snapshots(spark, f"{tmp_path}/a").orderBy("section_id").collect()] == [("§_1", "b"), ("§_2", "c")]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "S1.json").write_text('{"heading": "h", "body": "b"}')
    (tmp_path / "b" / "bad.json").write_text("{this is not json")
    assert [(r.section_id, r.body) for r in read_sections(spark, f"{tmp_path}/b").collect()] == [("S1", "b")]
    (tmp_path / "m.json").write_text('{"A": "1", "B": "2"}')
    assert sorted(tuple(r) for r in read_map(spark, f"{tmp_path}/m.json").collect()) == [("A", "1"), ("B", "2")]
    out = f"{tmp_path}/out"
    for law in ("x", "y", "x"):
        write_versions(spark.createDataFrame([(law, "§_1", "b")], "abbrev string, section_id string, body string"), out)
    assert spark.read.parquet(out).count() == 2


def test_replies(spark, tmp_path):
    from statuta.sources.paged_api import documents_of, rows_of_reply

    ref = {"Data": {"Metadaten": {"Technisch": {"ID": "N1"}, "Bundesrecht": {"Kurztitel": "K", "BrKons": {"Typ": "BG"}}}}}
    reply = {"OgdSearchResult": {"OgdDocumentResults": {"OgdDocumentReference": [ref, "x"], "Hits": {"#text": "101", "@pageSize": "100", "@pageNumber": "1"}}}}
    rows, last = rows_of_reply(reply)
    assert rows == [("N1", "", "BG", "", "", "", "", "K", "")] and not last
    assert rows_of_reply({}) == ([], True)
    reply["OgdSearchResult"]["OgdDocumentResults"]["OgdDocumentReference"] = [ref]
    (tmp_path / "r.json").write_text(json.dumps(reply))
    got = documents_of(spark, f"{tmp_path}/r.json").first()
    assert (got.nor_id, got.typ, got.name, got.apa) == ("N1", "BG", "K", "")


def test_paging(monkeypatch):
    from statuta.sources.paged_api import PagedReader

    asked = []

    def ask(self, parameters):
        asked.append(parameters["Seitennummer"])
        page = int(parameters["Seitennummer"])
        return {"OgdSearchResult": {"OgdDocumentResults": {"OgdDocumentReference": [{}] * (100 if page < 3 else 7), "Hits": {"#text": "207", "@pageSize": "100", "@pageNumber": str(page)}}}}

    monkeypatch.setattr(PagedReader, "ask", ask)
    reader = PagedReader({"url": "x", "keys": '[{"Gesetzesnummer": "1"}, {"Gesetzesnummer": "2"}]'})
    assert len(reader.partitions()) == 2 and len(list(reader.read(reader.partitions()[0]))) == 207 and asked == ["1", "2", "3"]
    many = PagedReader({"url": "x", "keys": json.dumps([{"Gesetzesnummer": str(k)} for k in range(12)]), "at_once": "5"})
    assert len(many.partitions()) == 5 and sum(len(p.scans) for p in many.partitions()) == 12


def test_crawl_by_ranges(monkeypatch):
    """A crawl of many pages is cut into ranges; bad pages are passed over, a range ends after dry pages."""
    from statuta.sources.paged_api import PagedReader

    asked = []

    def ask(self, parameters):
        page = int(parameters["Seitennummer"])
        asked.append(page)
        if page == 3:
            raise OSError("timed out")
        return {"OgdSearchResult": {"OgdDocumentResults": {"OgdDocumentReference": [{}] * (10 if page < 25 else 0), "Hits": {"#text": "99999", "@pageSize": "100", "@pageNumber": str(page)}}}}

    monkeypatch.setattr(PagedReader, "ask", ask)
    reader = PagedReader({"url": "x", "keys": '[{"Typ": "BG"}]', "pages": "60", "range": "20", "dry": "5", "at_once": "2"})
    assert [[(a, b) for _, a, b in p.scans] for p in reader.partitions()] == [[(1, 20), (41, 60)], [(21, 40)]]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(rows) == 230 and sorted(asked) == [*range(1, 31), *range(41, 47)]


def test_documents_and_sinks(spark, tmp_path):
    from statuta.sources import files
    from statuta.sources.paged_api import dated

    for name, text in (("N1", "<a/>"), ("N2", "")):
        (tmp_path / "xml").mkdir(exist_ok=True)
        (tmp_path / "xml" / f"{name}.xml").write_text(text)
    docs = files.read_documents(spark, str(tmp_path / "xml"))
    got = sorted((r.nor_id, r.nutzdaten, r.abgerufen_am is not None) for r in docs.collect())
    assert ("N1", "<a/>", True) in got and set(got) <= {("N1", "<a/>", True), ("N2", "", True)}  # an empty file may give no row
    docs = spark.createDataFrame([("N1", "<a/>", None), ("N2", "", None)], "nor_id string, nutzdaten string, abgerufen_am timestamp")
    cache = str(tmp_path / "cache")
    files.keep_documents(docs, cache)
    files.keep_documents(docs.withColumn("nutzdaten", F.lit("<later/>")), cache)
    assert sorted((r.nor_id, r.nutzdaten) for r in spark.read.parquet(cache).collect()) == [("N1", "<a/>"), ("N2", "<later/>")]
    (tmp_path / "tree" / "A B").mkdir(parents=True)
    (tmp_path / "tree" / "A B" / "fassung.json").write_text(json.dumps({"§_1": {"heading": "h", "body": "b"}}))
    assert [(r.abbrev, r.section_id, r.body) for r in files.read_working_tree(spark, str(tmp_path / "tree")).collect()] == [("A B", "§_1", "b")]
    versions = spark.createDataFrame([("A", "2017-01-01", "x" * 130), ("A", "1811-06-01", None)], "abbrev string, fassung_vom string, aenderung string")
    files.write_messages(versions, str(tmp_path / "v"))
    got = {r.fassung_vom: (r.message, len(r.aenderung), r.author_date) for r in spark.read.parquet(str(tmp_path / "v")).collect()}
    assert got == {"2017-01-01": (f"A [2017-01-01]: {'x' * 120}", 120, "2017-01-01"), "1811-06-01": ("A [1811-06-01]: ", 0, None)}
    files.write_artefact(versions, str(tmp_path / "out"))
    files.write_artefact(versions, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    index = spark.createDataFrame([("N1", ""), ("N2", "2020-01-01")], "nor_id string, inkrafttretensdatum string")
    assert [(r.nor_id, r.fassung_vom) for r in dated(index).collect()] == [("N2", "2020-01-01")]


def test_versions_from_documents(spark):
    """From the index and the documents to versions; what gives no section is an error with its reason."""
    from datetime import datetime

    from statuta.operators import versions as ver
    from statuta.operators.xml_sections import sections_of_index

    xml = lambda *texts: "<d><nutzdaten>" + "".join(f'<absatz ct="text">{x}</absatz>' for x in texts) + "</nutzdaten></d>"
    at = [datetime(2020, 1, k) for k in (1, 2)]
    records = [(1, "N1", "§ 1", xml("alt"), at[0]), (2, "N1", "§ 1", xml("neuer Text"), at[1]), (3, "N2", "§ 1", xml("kurz"), at[0]), (4, "N3", "§ 2", "<kaputt", at[0]), (5, "N4", "§ 3", xml(), at[0]), (6, "N5", "§ 4", None, at[0]), (7, None, "§ 9", xml("x"), at[0])]
    docs = spark.createDataFrame(records, "xml_id long, nor_id string, apa string, nutzdaten string, abgerufen_am timestamp_ntz")
    index = spark.createDataFrame([("A", d, n, k) for d in ("d1", "d2") for k, n in enumerate(["N1", "N2", "N3", "N4", "N5", "N6", None])], "abbrev string, fassung_vom string, nor_id string, arrival long")
    parsed = sections_of_index(index, docs)
    assert {(r.nor_id, r.outcome) for r in parsed.collect()} == {("N1", "section"), ("N2", "section"), ("N3", "malformed"), ("N4", "no block"), ("N5", "no data"), ("N6", "not fetched")}
    snapshot = ver.build_snapshot(parsed.where("outcome = 'section'").drop("body_blocks"))
    assert sorted((r.fassung_vom, r.section_id, r.body) for r in snapshot.collect()) == [("d1", "§_1", "neuer Text"), ("d2", "§_1", "neuer Text")]


def test_place(spark):
    from statuta.operators.ranking import with_place

    values = [5, 3, 9, 1, 7, 2]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    assert {r.v: r.place for r in with_place(df, "place", F.desc("v")).collect()} == {v: k + 1 for k, v in enumerate(sorted(values, reverse=True))}
    assert with_place(df.limit(0), "place", "v").count() == 0


def test_law_issues(spark):
    from statuta.operators import quality

    rows = [("A", "d1", "§_1", "x", 1), ("A", "d2", "§_1", "", 2), ("B", "d1", "§_1", "x", 3), ("D", "d1", "§_1", "x", 4)]
    sections = spark.createDataFrame(rows, "abbrev string, fassung_vom string, section_id string, body string, arrival long")
    commits = spark.createDataFrame([("A", "d1", "A [2020-01-01]: "), ("A", "d2", "ohne Datum"), ("B", "d1", "B [2020-01-01]: "), ("B", "d9", "B [2020-01-02]: "), ("C", "d1", "C [2020-01-01]: ")], "gsn string, fassung_vom string, message string")
    diffs = spark.createDataFrame([("A", f"Section-{k}", "a", "b", "changed") for k in range(4)] + [("A", "a", None, None, "changed")], "abbrev string, section_id string, old_body string, new_body string, change_kind string")
    got = {(r.abbrev, r.check, r.n) for r in quality.law_issues(sections, commits, diffs).collect()}
    assert got == {("A", "empty_fassung", 1), ("A", "commit_messages", 1), ("A", "diff_section_n", 3), ("B", "missing_fassung", 1), ("B", "latest_empty", 1), ("C", "api_error", 1), ("D", "git_error", 1)}
    assert {(r.abbrev, r.check) for r in quality.law_issues(sections, commits, diffs.limit(0)).collect()} >= {("A", "empty_diff")}


def test_intermediates(spark):
    from statuta.sources.stored import intermediates, stored

    with intermediates():
        kept = stored(spark.range(5))
        assert kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(kept._stored_at).count()


def test_xml_tables(spark):
    from statuta.operators.shred import tables_by_path

    xml = '<d><liste><listelem ct="text"><symbol>1.</symbol>eins<liste><listelem ct="text"><symbol>a)</symbol>innen</listelem></liste></listelem></liste></d>'
    nodes = shred_xml(spark.createDataFrame([(1, xml), (2, "<kaputt")], "id long, x string"), "id", "x")
    tables = tables_by_path(nodes, ["listelem", "symbol", "fehlt"])
    assert {r.parent_dewey for r in tables["symbol"].collect()} == {r.dewey for r in tables["listelem"].collect()} == {"1.1.1", "1.1.1.2.1"}
    assert tables["fehlt"].count() == 0


def test_store_and_cli(spark, tmp_path):
    from statuta.api import LawStore, render

    rows = [("A", "2017-01-01", "§_1", "Ziel", "§ 1. alt.", "Paragraf", 1), ("A", "2017-01-01", "§_2", "Zwei", "§ 2. gleich.", "Paragraf", 2), ("A", "2018-01-01", "§_1", "Ziel", "§ 1. neu.", "Paragraf", 3), ("A", "2018-01-01", "Anlage_1", "", "Tarif", "Anlage", 4)]
    store = LawStore(spark.createDataFrame(rows, "abbrev string, fassung_vom string, section_id string, heading string, body string, section_type string, arrival long"))
    kinds = {r.section_id: r.change_kind for r in store.diff("A", "2017-01-01", "2018-01-01").collect()}
    assert kinds == {"§_1": "changed", "§_2": "removed", "Anlage_1": "added"}
    assert [r.section_id for r in store.diff("A", "2017-01-01", "2018-01-01", section_type="Anlage").collect()] == ["Anlage_1"]
    back = {r.section_id: r.change_kind for r in store.diff("A", "2018-01-01", "2017-01-01").collect()}
    assert back == {"§_1": "changed", "§_2": "added", "Anlage_1": "removed"}
    assert [r.section_id for r in store.as_of("A", "2018-01-01").collect()] == ["§_1", "§_2", "Anlage_1"]
    assert {r.section_id: (r.old_body, r.new_body) for r in store.diff_as_of("A", "2017-01-01", "2018-01-01").collect() if r.change_kind == "changed"} == {"§_1": ("alt.", "neu.")}
    assert {r.change_kind for r in store.diff("A", "2017-01-01", "2017-01-01", section_id="x").collect()} == {"unchanged"}
    with pytest.raises(LookupError):
        store.diff("A", "2017-01-01", "1999-01-01")
    with pytest.raises(LookupError):
        store.versions("B")
    assert "1 changed" not in render(store.diff("A", "2017-01-01", "2018-01-01"), "A") and render(store.diff("A", "2017-01-01", "2018-01-01"), "A").endswith("3 changed, 0 unchanged")
    assert "\033[32m+ § 1. neu." in render(store.diff("A", "2017-01-01", "2018-01-01"), "A", True)
    assert [r.abbrev for r in store.laws("a").collect()] == ["A"] and store.changes("A").count() == 3
    commits = spark.createDataFrame([("A", "2017-01-01", 1, "alt", "A [2017-01-01]: alt"), ("A", "2017-01-01", 2, "neuer", "A [2017-01-01]: neuer")], "abbrev string, fassung_vom string, version_id long, aenderung string, message string")
    catalog = spark.createDataFrame([("A", "3. Gebührengesetz", "GebG", "BG", 1)], "gsn string, name string, abbrev string, typ string, cat_id long")
    full = LawStore(spark.createDataFrame(rows, "abbrev string, fassung_vom string, section_id string, heading string, body string, section_type string, arrival long"), commits, catalog, listed=commits.select("abbrev"))
    assert [r.name for r in full.laws("gebühren").collect()] == ["Gebührengesetz"] and full.laws("nichts").count() == 0
    law = full.law("A")
    assert (law["name"], law["versions_count"], law["sections"], law["synthetic"]) == ("Gebührengesetz", 2, 3, True)
    assert [(r.fassung_vom, r.aenderung, r.sections, r.changed_count, r.changed_sections) for r in law["versions_list"].collect()] == [("2018-01-01", None, 3, 3, ["§_1", "§_2", "Anlage_1"]), ("2017-01-01", "neuer", None, 0, [])]
    assert [len(r.short_id or "") for r in law["versions_list"].collect()] == [0, 8]


def test_stream(spark, tmp_path):
    from statuta.streaming.ingest import follow

    cols = "abbrev string, fassung_vom string, section_id string, heading string, body string, section_type string, arrival long"
    make = lambda rows: spark.createDataFrame(rows, cols)
    src, out, ck = (f"{tmp_path}/{x}" for x in ("src", "out", "ck"))
    schema = make([]).schema
    make([("A", "d1", "§_1", "", "kurz", "P", 1), ("B", "d1", "§_1", "", "b", "P", 2)]).write.parquet(src)
    follow(spark, src, schema, out, ck).awaitTermination()
    make([("A", "d1", "§_1", "", "viel länger", "P", 3), ("A", "d2", "§_1", "", "x", "P", 4), (None, "d2", "§_1", "", "x", "P", 5)]).write.mode("append").parquet(src)
    follow(spark, src, schema, out, ck).awaitTermination()
    assert sorted((r.abbrev, r.fassung_vom, r.body) for r in spark.read.parquet(out).collect()) == [("A", "d1", "viel länger"), ("A", "d2", "x"), ("B", "d1", "b")]


def test_latest_writes(spark, tmp_path):
    from datetime import datetime

    from statuta.streaming.ingest import latest_writes

    rows = [("A", datetime(2020, 1, 1, 5)), ("A", datetime(2020, 1, 1, 7)), ("B", datetime(2020, 1, 2)), ("A", datetime(2020, 2, 1)), ("A", None)]
    df = spark.createDataFrame(rows, "gsn string, geladen_am timestamp_ntz")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = latest_writes(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
    stream.writeStream.format("memory").queryName("loads").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").start().awaitTermination()
    got = sorted((str(r.window.start)[:10], r.gsn, r.rows) for r in spark.table("loads").collect())
    assert got == [("2020-01-01", "A", 2), ("2020-01-02", "B", 1), ("2020-02-01", "A", 1)]


def test_many_wordings_of_one_section(spark):
    full = "§ 1. Die Gebühr Nummer {0} beträgt zehn Euro im Jahr und ist am Ersten fällig."
    rows = [(k, "g", "d", "§_1", None, full.format(k) if k % 3 else full.format(k)[:30], None, None) for k in range(600)]
    q = spark.createDataFrame([("a", 1)], "quelle string, rang int")
    assert [r.rec_id for r in kept_texts(fassung(spark, rows), q).collect()] == [1]


def test_xml_sections(spark):
    from statuta.operators.xml_sections import parse_sections, unknown_tags

    xml = """<dok><nutzdaten><absatz ct="kurztitel">Titel</absatz><ueberschrift typ="titel" ct="text">weg</ueberschrift><ueberschrift typ="para" ct="text">Gebühren</ueberschrift>
<absatz ct="text"><gldsym>§ 5.</gldsym> Die <i>Gebühr</i> ist</absatz><liste><schlussteil ct="text">vorab</schlussteil><aufzaehlung><listelem ct="text"><symbol>a)</symbol>eins</listelem><listelem ct="x"/></aufzaehlung></liste>
<strichliste><listelem ct="text"><symbol>–</symbol> zwei</listelem></strichliste><abschnitt><absatz ct="text">Ende.</absatz></abschnitt><neu>x</neu></nutzdaten></dok>"""
    df = spark.createDataFrame([(1, xml, "§ 5"), (2, "<a", ""), (3, None, None), (4, "<dok><nutzdaten/></dok>", "")], "xml_id long, nutzdaten string, apa string")
    r = parse_sections(df).collect()
    assert len(r) == 1 and r[0].section_id == "§_5" and r[0].heading == "Gebühren" and r[0].section_type == "Paragraf"
    assert r[0].body == "§ 5. Die Gebühr ist\nvorab\na) eins\n– zwei\nEnde."
    assert [(b.type, b.style) for b in r[0].body_blocks] == [("text", None), ("list", "schluss"), ("list", "letters"), ("list", "dash"), ("text", None)]
    assert [tuple(x) for x in unknown_tags(df).collect()] == [("neu", 1)]


def many_texts():
    """One key with 400 wordings, each also without its end and without its middle: [(text, whether it is whole)]."""
    out = []
    for k in range(400):
        full = f"§ 1. Fall {k} betrifft die Gebühr.\n1. Für Erwachsene gelten {k} Euro im ganzen Jahr.\n2. Für Kinder gilt Fall {k} nicht."
        lines = full.split("\n")
        out += [(full, True), ("\n".join(lines[:2]), False), (lines[0] + "\n" + lines[2], False)]
    return out


@pytest.mark.parametrize("size", [50, 4096])
def test_key_of_many_texts(spark, monkeypatch, size):
    """The texts of one key are judged alike, however many they are and however they are sliced."""
    monkeypatch.setattr(duplicates, "SLICE", size)
    texts = many_texts()
    got = damages(spark, [(t, False) for t, _ in texts])
    assert {k: d == 0 for k, d in got.items()} == {k: whole for k, (_, whole) in enumerate(texts)}


def test_kept_text_of_many(spark):
    """A cut text of the better source loses against its whole text wherever that one's hash falls."""
    texts = many_texts()
    rows = [(k, "g", "d", "§_1", None, t, "b" if whole else "a", None) for k, (t, whole) in enumerate(texts)]
    q = spark.createDataFrame([("a", 1), ("b", 2)], "quelle string, rang int")
    assert [r.rec_id for r in kept_texts(fassung(spark, rows), q).collect()] == [0]


def brute_final(entries, laws):
    """The final list by comparing every entry with every law: {gsn: (entry_id, score)}, {entry_id: gsn}."""
    import re
    from difflib import SequenceMatcher

    def plain(s):
        return re.sub(r"\s+", " ", re.sub(r"[.,;:()\-/]", " ", re.sub(r"\b(19|20)\d{2}\b", "", s.lower().strip()))).strip()

    def year(s):
        return max(map(int, re.findall(r"\b((?:19|20)\d{2})\b", s)), default=None)

    def similar(a, b):
        x, y = set(a.split()), set(b.split())
        return 1.0 if a == b else 0.6 * len(x & y) / len(x | y) + 0.4 * SequenceMatcher(None, a, b).ratio()

    chosen = {}
    for i, name, abbrev in entries:
        p, n = plain(abbrev), plain(name)
        hits = {g: 1.0 for g, _, a, _ in laws if a and a.lower() == abbrev.lower()}
        hits = hits or {g: 0.95 for g, _, a, _ in laws if p and plain(a) == p}
        hits = hits or {g: 0.85 for g, _, a, _ in laws if p and plain(a) and (p in plain(a) or plain(a) in p)}
        if not hits:
            near = {g: similar(n, plain(x)) for g, x, _, _ in laws if plain(x).split()[:1] and plain(x).split()[0] in n.split()[:2]}
            near = {g: v for g, v in near.items() if v >= 0.6}
            hits = {g: v for g, v in near.items() if v >= max(near.values()) - 0.02}
        if not hits:
            continue
        of = {g: (x, a) for g, x, a, _ in laws}
        same = [g for g in hits if of[g][1].lower() == abbrev.lower()]
        y = year(name) or year(abbrev)
        dated = [g for g in hits if y and year(of[g][0]) == y]
        g = same[0] if len(same) == 1 else max(dated or hits)
        chosen[i] = (g, hits[g])
    best = {}
    for i, (g, v) in sorted(chosen.items()):
        if g not in best or v > best[g][1]:
            best[g] = (i, v)
    return best, {i: g for i, (g, _) in chosen.items()}


def test_final_list_cascade(spark, tmp_path):
    """Every step of the cascade leads to the final list, also for entries whose words match no law."""
    laws = [("10", "Zollgesetz 1988", "ZollG", "BG"), ("11", "Mühlenverordnung über Mehl", "MV 1990", "V"), ("12", "Luftgesetz über Quoten", "LuftQuG-Bund", "BG"), ("13", "Parkgesetz der alpinen Gebiete", "", "BG"), ("14", "Parkgesetz der mobilen Anlagen", "", "BG"), ("15", "Wasserrecht 1990", "WR", "BG"), ("16", "Wasserrecht 1995", "WR", "BG")]
    entries = [(1, "Regelung anderer Art", "zollg"), (2, "Ohne gleiche Worte", "MV"), (3, "Etwas ganz anderes", "LuftQuG"), (4, "Parkgesetz der alpinen Gebiet", ""), (5, "Anderes von 1990", "WR"), (6, "Parkgesetz", ""), (7, "Zollgesetz", "x-unbekannt"), (8, "Nichts davon", "")]
    spark.createDataFrame([(i, n, a) for i, n, a in entries], "entry_id long, index_name string, index_abbrev string").write.parquet(str(tmp_path / "final_gsn_list.parquet"))
    spark.createDataFrame([(k, *x) for k, x in enumerate(laws)], "cat_id long, gsn string, name string, abbrev string, typ string").write.parquet(str(tmp_path / "law_catalog_merged.parquet"))
    best, chosen = brute_final(entries, laws)
    assert {best[g][0] for g in ("10", "11", "12", "15")} == {1, 2, 3, 5}  # by abbreviation alone
    names = {i: n for i, n, _ in entries}
    assert {r.entry_id: r.gsn for r in laws_plans.disambiguate_cascade(spark, str(tmp_path)).collect()} == chosen
    got = {r.gsn: (r.index_name, round(r.score, 9)) for r in laws_plans.final_list_cascade(spark, str(tmp_path)).collect()}
    assert got == {g: (names[i], round(v, 9)) for g, (i, v) in best.items()}
    assert {r.catalog_typ: r.laws for r in laws_plans.count_by_type_cascade(spark, str(tmp_path)).collect()} == dict(Counter(t for g, _, _, t in laws if g in best))
