"""The queries of this package, which SQL can't express, over whole tables: what must hold of their rows."""

import os
from collections import Counter

import duckdb
import pytest

from statuta.llm import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def rows(spark, name):
    return registry.QUERIES[name](spark, FOLDER).collect()


def sql(text):
    return duckdb.connect().sql(text.replace("@", FOLDER + "/")).fetchall()


def test_links(spark):
    links = rows(spark, "p2_links")
    assert links and {(r.entry_id, r.gsn) for r in links} == {tuple(r) for r in rows(spark, "p2_found")}
    assert len({r.entry_id for r in links}) == len(links) and all(0.5 <= r.confidence <= 1 for r in links)
    assert {r.gsn for r in links} <= {g for (g,) in sql("select gsn from '@law_catalog_merged.parquet'")}


def test_normalized(spark):
    found = {(r.tab, r.rec_id, r.field_name) for r in rows(spark, "p3_found")}
    new = rows(spark, "p3_normalized")
    assert found and {(r.tab, r.rec_id, r.field_name) for r in new} == found and all(r.text.isprintable() or "\n" in r.text for r in new)


def test_survivors_are_of_their_groups(spark):
    kept = rows(spark, "p5_found")
    of = {r: (g, d) for r, g, d in sql("select rec_id, gsn, fassung_vom from '@fassung.parquet'")}
    assert kept and all(of[r.body_rec_id] == of[r.heading_rec_id] for r in kept)
    assert len({r.body_rec_id for r in kept}) == len(kept)


def test_counts(spark):
    ids = {r.doc_id: len(r.ids) for r in rows(spark, "p7_ids")}
    assert ids == {r.doc_id: r.n_tokens for r in rows(spark, "p7_counts")}
    assert all(ids[k] == 0 for (k,) in sql("select doc_id from '@documents.parquet' where coalesce(text, '') = ''"))
    assert len(ids) == sql("select count(*) from '@documents.parquet'")[0][0]


def test_shares(spark):
    """Each source reaches its share to within one document, and no document is used more often than allowed."""
    mix, weights = rows(spark, "p8_mix"), {s: (w, c) for s, w, c in sql("select * from '@source_weights.parquet'")}
    of = dict(sql("select doc_id, source from '@documents.parquet'"))
    tokens, longest = Counter(), Counter()
    for r in mix:
        assert of[r.doc_id] == r.source and 0 < r.times <= weights[r.source][1]
        tokens[r.source] += r.times * r.n_tokens
        longest[r.source] = max(longest[r.source], r.n_tokens)
    total = sum(tokens.values())
    shares = {r.source: r for r in rows(spark, "p8_shares")}
    assert set(shares) == set(weights)
    for s, (w, cap) in weights.items():
        assert shares[s].n_tokens == tokens[s] and abs(tokens[s] - w * total) <= cap * longest[s] + sum(longest.values()) * w
        assert abs(shares[s].actual_share - tokens[s] / total) < 1e-9


def test_shared(spark):
    pairs = {tuple(r) for r in rows(spark, "p9_found")}
    text = dict(sql("select doc_id, text from '@documents.parquet'"))
    assert pairs and all(a < b for a, b in pairs)
    for a, b in sorted(pairs)[:40]:
        held = {text[a][k : k + 200] for k in range(len(text[a]) - 199)}
        assert any(text[b][k : k + 200] in held for k in range(len(text[b]) - 199))
    linked = {r.doc_id: r for r in rows(spark, "p9_links")}
    assert {d for p in pairs for d in p} == {d for d, r in linked.items() if r.n_copies > 1 or r.n_links > 0}
    shared = {r.doc_id: r for r in rows(spark, "p9_shared")}
    assert {d for d, r in shared.items() if r.shared_chars > 0} == {d for p in pairs for d in p} and set(shared) == set(text)
