"""Every query that has SQL gives the same rows as the SQL does, over whole tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    if isinstance(v, dict):
        return [plain(x) for x in v.values()]
    return [plain(x) for x in v] if isinstance(v, list | tuple) else str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for name in os.listdir(FOLDER):
        c.sql(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    return c


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query(spark, db, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    result = db.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(repr([plain(r[columns.index(c)]) for c in sorted(columns)]) for r in result.fetchall())
    assert sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in df.collect()) == expected


def frame(spark, name):
    return __spark_entry__.queries()[name](spark, FOLDER)


def count(db, sql):
    return db.execute(sql).fetchall()[0][0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_list_items(spark, db):
    """All of fassung's items, and as many of nor_xml as the parsed tables have."""
    found = frame(spark, "p1_found").groupBy("tab").count().collect()
    counts = {r.tab: r["count"] for r in found}
    filled = "select count(*) from (select unnest(b.items) as i from (select unnest(body_blocks) as b from fassung) where b.items is not null) where trim(coalesce(i.symbol, '')) <> '' or trim(coalesce(i.text, '')) <> ''"
    assert counts["fassung"] == count(db, filled)
    assert counts["nor_xml"] == frame(spark, "p1_xml_items").count() > 0
    lists = {(r.xml_id, r.dewey) for r in frame(spark, "p1_xml_lists").collect()}
    assert any((r.xml_id, r.list_dewey) in lists for r in frame(spark, "p1_xml_items").limit(50).collect())
    assert frame(spark, "p1_xml_paths").agg({"nodes": "sum"}).first()[0] > counts["nor_xml"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_histories_and_changes_agree(spark):
    """Periods of one section don't meet with equal wordings; each beginning but the first, and each end, is a change."""
    periods = frame(spark, "p4_found").collect()
    assert len(periods) == frame(spark, "p4_history").count() and all(p.valid_from < p.valid_to for p in periods)
    changes = {(r.gsn, r.fassung_vom, r.section_id): r.change_kind for r in frame(spark, "p6_found").collect()}
    begins = {(p.gsn, p.valid_from, p.section_id) for p in periods}
    ends = {(p.gsn, p.valid_to, p.section_id) for p in periods if p.valid_to != "9999-12-31"}
    first = {}
    for p in periods:
        first[p.gsn] = min(first.get(p.gsn, p.valid_from), p.valid_from)
    due = {k: "changed" if k in begins and k in ends else "added" if k in begins else "removed" for k in begins | ends if k[1] != first[k[0]]}
    assert changes == due


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_scripts_rebuild_both_sides(spark):
    """The edit scripts of paragraphs and words hold the old and the new side in order."""
    from statuta.functions.law_text import paragraphs
    from pyspark.sql import functions as F

    both = frame(spark, "diff_versions").where("change_kind = 'changed'").select("abbrev", "fassung_vom", "section_id", paragraphs(F.col("old_body")).alias("o"), paragraphs(F.col("new_body")).alias("n"))
    rows = both.join(frame(spark, "paragraph_diff"), ["abbrev", "fassung_vom", "section_id"]).collect()
    assert rows and all([s.old for s in r.script if s.old is not None] == r.o and [s.new for s in r.script if s.new is not None] == r.n for r in rows)
    words = frame(spark, "word_diff").collect()
    assert words and all(s.old == s.new for r in words for s in r.script if s.op == "context")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_documents(spark, db):
    """Every record has one outcome; parsed ones are the sections; errors and sections together are the documents named."""
    outcomes = {r.rec_id: r.outcome for r in frame(spark, "xml_outcomes").collect()}
    assert len(outcomes) == count(db, "select count(*) from nor_xml")
    assert {r.rec_id for r in frame(spark, "xml_parse").collect()} == {k for k, o in outcomes.items() if o == "section"}
    assert {r[0] for r in db.execute("select xml_id from nor_xml where coalesce(nutzdaten, '') = ''").fetchall()} <= {k for k, o in outcomes.items() if o == "no data"}
    built, errors = frame(spark, "build_fassung_xml").count(), frame(spark, "build_fassung_errors").count()
    named = count(db, "select count(*) from (select distinct gsn, fassung_vom, nor_id from fassung where nor_id is not null)")
    assert 0 < built <= named - errors and errors < named


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_matches(spark, db):
    """Every entry has a status; the final lists follow from the cascade."""
    cascade = frame(spark, "match_cascade").collect()
    assert {r.entry_id for r in cascade} == {r[0] for r in db.execute("select entry_id from final_gsn_list").fetchall()}
    assert all((r.gsn is None) == (r.status == "unmatched") and (r.gsn is None or 0.6 <= r.score <= 1) for r in cascade)
    chosen = {(r.entry_id, r.gsn) for r in frame(spark, "disambiguate_cascade").collect()}
    assert chosen <= {(r.entry_id, r.gsn) for r in cascade} and len(chosen) == len({r.entry_id for r in cascade if r.gsn})
    final = frame(spark, "final_list_cascade").collect()
    assert {r.gsn for r in final} == {g for _, g in chosen}
    assert sum(r.laws for r in frame(spark, "count_by_type_cascade").collect()) == len(final)
    fuzzy = frame(spark, "match_blocked_fuzzy").collect()
    assert all(0.6 <= r.score <= 1 for r in fuzzy) and frame(spark, "xml_unknown_tags").count() >= 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["gsn", "fassung_vom", "section_id", "change_kind"]
