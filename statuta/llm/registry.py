"""The queries of this package over the tables of a folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import bpe, consensus, linkage, mixing, spans, spelling


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """entry_id, gsn of every register entry whose law is in the catalog."""
    return p2_links(spark, d).select("entry_id", "gsn")


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """The same with the confidence of each link."""
    return linkage.link(table(spark, d, "final_gsn_list"), table(spark, d, "law_catalog_merged"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """tab, rec_id, field_name of every text that is not in the consistent form."""
    return spelling.inconsistent(spelling.law_texts(table(spark, d, "law_catalog_merged"), table(spark, d, "fassung")))


def p3_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Those texts in the consistent form."""
    return spelling.normalized(spelling.law_texts(table(spark, d, "law_catalog_merged"), table(spark, d, "fassung")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """body_rec_id, heading_rec_id of every group of duplicate section rows."""
    return consensus.survivors(table(spark, d, "fassung"), table(spark, d, "quellen")).select("body_rec_id", "heading_rec_id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, ids of every document."""
    return bpe.encode(table(spark, d, "documents"))


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, n_tokens of every document."""
    return bpe.count_tokens(table(spark, d, "documents"), "doc_id")


def _mixture(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("sources", F.when(F.col("source").isNotNull(), F.array("source")))
    return mixing.mix(bpe.count_tokens(docs, "doc_id", "sources"), table(spark, d, "source_weights"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source, times, n_tokens of every document in the mixture."""
    return _mixture(spark, d)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source."""
    return mixing.shares(_mixture(spark, d), table(spark, d, "source_weights"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """doc_id_a, doc_id_b of every two documents that share a run of 200 characters or more."""
    docs = table(spark, d, "documents")
    met = spans.met_hashes(docs)
    return spans.record_pairs(spans.text_pairs(spans.candidate_spans(docs, met=met)), spans.members(docs, met=met))


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, n_chars, shared_chars, share of every document."""
    docs = table(spark, d, "documents")
    met = spans.met_hashes(docs)
    return spans.shared_share(docs, spans.shared_spans(spans.candidate_spans(docs, met=met)), met=met)


def p9_links(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, class_id (of equal texts), n_copies, n_links (to other texts) of every document of 200 characters or more."""
    docs = table(spark, d, "documents")
    met = spans.met_hashes(docs)
    return spans.linked_classes(spans.text_pairs(spans.candidate_spans(docs, met=met)), spans.members(docs, met=met))


QUERIES = {f.__name__: f for f in (p2_found, p2_links, p3_found, p3_normalized, p5_found, p7_ids, p7_counts, p8_mix, p8_shares, p9_found, p9_shared, p9_links)}

ORACLES: dict[str, str] = {}
