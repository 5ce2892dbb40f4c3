"""Files of snapshots, sections, maps and documents, and the sinks: the table of versions, artefacts as JSON or parquet.

A snapshot file holds one JSON object from section id to section. A file of one section is named after its id, which
stands in for a missing ``section_id``. Broken files give no rows (``strict=True``: an error).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.law_text import version_message
from ..operators.versions import author_date

SECTION = "section_id string, heading string, body string, section_type string, fassung_vom string, body_blocks array<struct<type:string,text:string,style:string,items:array<struct<symbol:string,text:string>>>>"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """path, section_id and the section's fields of every snapshot file below ``path``."""
    text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = text.withColumn("m", F.from_json("value", f"map<string,struct<{SECTION.replace(' ', ':').replace(',:', ',')}>>"))
    rows = parsed.select("path", F.explode("m").alias("key", "s")).select("path", "key", "s.*")
    return rows.withColumn("section_id", F.coalesce("section_id", "key")).drop("key")


def read_sections(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """One row a section file; the file's name is the id where the section has none."""
    rows = spark.read.schema(SECTION + (", _broken string" if not strict else "")).option("multiLine", "true").option("columnNameOfCorruptRecord", "_broken").option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    rows = rows.withColumn("_file", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1))
    if not strict:
        rows = rows.where("_broken is null").drop("_broken")
    return rows.withColumn("section_id", F.coalesce("section_id", F.url_decode("_file"))).drop("_file")


def read_map(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """A flat JSON object of texts as rows."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def read_working_tree(spark: SparkSession, path: str) -> DataFrame:
    """abbrev, section_id and the section's fields of laws without a version store: one folder a law with its one snapshot file.

    Such a law has one version, whatever date is asked for.
    """
    rows = read_snapshots(spark, path)
    return rows.withColumn("abbrev", F.url_decode(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))).drop("path")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """nor_id (the file's name), nutzdaten (the XML text) and abgerufen_am (the file's time) of every XML file below ``path``."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").text(path, wholetext=True)
    return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.xml$", 1).alias("nor_id"), F.col("value").alias("nutzdaten"), F.col("_metadata.file_modification_time").alias("abgerufen_am"))


def keep_documents(fetched: DataFrame, path: str) -> None:
    """Adds fetched documents (nor_id, nutzdaten, abgerufen_am) to the cache at ``path``; those it has already are left as they are."""
    spark = fetched.sparkSession
    new = fetched.where(F.col("nor_id").isNotNull() & (F.col("nutzdaten") != "")).groupBy("nor_id").agg(F.max(F.struct("abgerufen_am", "nutzdaten")).alias("d")).select("nor_id", "d.*")
    try:
        held = spark.read.parquet(path).select("nor_id")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = new.select("nor_id").limit(0)
    # the cache is read before the write begins, and appending leaves its files alone
    new.join(held, "nor_id", "left_anti").write.mode("append").parquet(path)


def write_artefact(df: DataFrame, path: str, kind: str = "json") -> None:
    """Writes a catalog, match list, final list, index or report as a folder of JSON lines or parquet, replacing what is there."""
    df.write.mode("overwrite").format(kind).save(path)


def write_messages(versions: DataFrame, path: str) -> None:
    """Writes versions (abbrev, fassung_vom, aenderung) with their messages and author dates, a folder each law.

    The amendment is cut after 120 characters; dates out of range have no author date. Whole laws are replaced.
    """
    message = version_message(F.col("abbrev"), F.col("fassung_vom"), F.col("aenderung"))
    rows = versions.select("abbrev", "fassung_vom", F.left(F.coalesce("aenderung", F.lit("")), F.lit(120)).alias("aenderung"), message.alias("message"), author_date(F.col("fassung_vom")).alias("author_date"))
    rows.repartition("abbrev").write.partitionBy("abbrev").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_versions(sections: DataFrame, path: str, law: str = "abbrev") -> None:
    """Writes whole laws, a folder each; laws written before and not in ``sections`` stay as they are.

    The rows of a law are replaced as a whole, so writing again after a failure does no harm.
    """
    # partitions by law and a range of its rows, so that a large law is several files written by several tasks
    (
        sections.repartition(F.col(law), F.pmod(F.xxhash64("section_id"), F.lit(8)))
        .write.partitionBy(law).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    )
