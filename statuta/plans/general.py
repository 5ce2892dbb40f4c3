"""Queries p1, p4 and p6 over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.duplicates import kept_texts
from ..operators.history import DeltaStore
from ..operators.shred import numbered_descendants, parent_label, shred_array_levels, shred_xml, tables_by_path
from ..operators.snapshot_diff import changes
from ..operators.xml_sections import STYLES
from ..sources.stored import stored
from ..sources.tables import table

_BLANK = r"(?U)^\s*$"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """tab, rec_id, parent_no, child_no of every list item in fassung.body_blocks and nor_xml.nutzdaten."""
    _, items = shred_array_levels(table(spark, d, "fassung"), "rec_id", ["body_blocks", "items"])
    filled = ~F.coalesce(F.col("symbol"), F.lit("")).rlike(_BLANK) | ~F.coalesce(F.col("text"), F.lit("")).rlike(_BLANK)
    fassung = items.where(filled).select(F.lit("fassung").alias("tab"), "rec_id", F.col("parent_dewey").cast("int").alias("parent_no"), F.col("no").alias("child_no"))
    listed = numbered_descendants(table(spark, d, "nor_xml"), "xml_id", "nutzdaten", "listelem", "ct", "text")
    return fassung.unionByName(listed.select(F.lit("nor_xml").alias("tab"), "rec_id", "parent_no", "child_no"))


def p1_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The table of blocks: rec_id, dewey, no, type, style, n_chars of the text."""
    blocks, _ = shred_array_levels(table(spark, d, "fassung"), "rec_id", ["body_blocks", "items"])
    return blocks.select("rec_id", "dewey", "no", "type", "style", F.length("text").alias("n_chars"))


def p1_items(spark: SparkSession, d: str) -> DataFrame:
    """The table of items: rec_id, dewey, block_dewey (the parent's label, by truncation), no, symbol, text."""
    _, items = shred_array_levels(table(spark, d, "fassung"), "rec_id", ["body_blocks", "items"])
    return items.select("rec_id", "dewey", parent_label(F.col("dewey")).alias("block_dewey"), "no", "symbol", "text")


def p1_xml_items(spark: SparkSession, d: str) -> DataFrame:
    """The items of all lists in nor_xml: xml_id, dewey, list_dewey (the label by truncation), symbol, text."""
    nodes = stored(shred_xml(table(spark, d, "nor_xml"), "xml_id", "nutzdaten", ["listelem", "symbol"]))
    tables = tables_by_path(nodes, ["listelem", "symbol"])
    # the first symbol of an item; equal labels order by length first, so that 2 comes before 10
    first = tables["symbol"].groupBy("rec_id", "parent_dewey").agg(F.min_by("text", F.struct(F.length("dewey"), "dewey")).alias("symbol"))
    items = tables["listelem"].where(F.col("attrs")["ct"] == "text")
    joined = items.join(first.withColumnRenamed("parent_dewey", "dewey"), ["rec_id", "dewey"], "left")
    return joined.select(F.col("rec_id").alias("xml_id"), "dewey", F.col("parent_dewey").alias("list_dewey"), "symbol", "text")


def p1_xml_lists(spark: SparkSession, d: str) -> DataFrame:
    """The lists in nor_xml: xml_id, dewey, parent_dewey, name, n_chars of all text inside."""
    nodes = shred_xml(table(spark, d, "nor_xml"), "xml_id", "nutzdaten", ["liste", *STYLES])
    return nodes.select(F.col("rec_id").alias("xml_id"), "dewey", parent_label(F.col("dewey")).alias("parent_dewey"), "name", F.length("text").alias("n_chars"))


def p1_xml_paths(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables that nor_xml falls into: schema_path, nodes, records, deepest (levels)."""
    nodes = shred_xml(table(spark, d, "nor_xml"), "xml_id", "nutzdaten")
    return nodes.groupBy("schema_path").agg(F.count("*").alias("nodes"), F.countDistinct("rec_id").alias("records"), F.max(F.size(F.split("dewey", r"\."))).alias("deepest"))


def _kept(spark: SparkSession, d: str) -> DataFrame:
    return kept_texts(table(spark, d, "fassung"), table(spark, d, "quellen"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """gsn, section_id, valid_from, valid_to of every wording of every section."""
    store = DeltaStore.build(_kept(spark, d), "gsn", "section", "text_hash", "fassung_vom")
    return store.validity().select("gsn", F.col("section").alias("section_id"), "valid_from", "valid_to")


def p4_history(spark: SparkSession, d: str) -> DataFrame:
    """The same with body_rec_id, the row whose body is the wording at the beginning of the period."""
    kept = stored(_kept(spark, d))
    runs = DeltaStore.build(kept, "gsn", "section", "text_hash", "fassung_vom").validity()
    rows = kept.select("gsn", "section", F.col("fassung_vom").alias("valid_from"), F.col("rec_id").alias("body_rec_id"))
    return runs.join(rows, ["gsn", "section", "valid_from"]).select("gsn", F.col("section").alias("section_id"), "valid_from", "valid_to", "body_rec_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """gsn, fassung_vom, section_id, change_kind of every difference between consecutive snapshots."""
    return changes(_kept(spark, d), "gsn", "fassung_vom", "section", "text_hash").withColumnRenamed("section", "section_id").select("gsn", "fassung_vom", "section_id", "change_kind")


QUERIES = {f.__name__: f for f in (p1_found, p1_blocks, p1_items, p1_xml_items, p1_xml_lists, p1_xml_paths, p4_found, p4_history, p6_found)}

ORACLES = {
    "p1_blocks": """
        select rec_id, cast(u.no as varchar) as dewey, cast(u.no as integer) as no, u.b.type as type, u.b.style as style, cast(length(u.b.text) as integer) as n_chars
        from (select rec_id, unnest(list_transform(range(1, len(body_blocks) + 1), lambda i: {'no': i, 'b': body_blocks[i]})) as u from fassung where body_blocks is not null)""",
    "p1_items": """
        with b as (select rec_id, u.no as bno, u.b.items as items from (select rec_id, unnest(list_transform(range(1, len(body_blocks) + 1), lambda i: {'no': i, 'b': body_blocks[i]})) as u from fassung where body_blocks is not null))
        select rec_id, cast(bno as varchar) || '.' || cast(v.no as varchar) as dewey, cast(bno as varchar) as block_dewey, cast(v.no as integer) as no, v.i.symbol as symbol, v.i.text as text
        from (select rec_id, bno, unnest(list_transform(range(1, len(items) + 1), lambda i: {'no': i, 'i': items[i]})) as v from b where items is not null)""",
}
