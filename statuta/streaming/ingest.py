"""Incremental ingest: new section rows arrive as files, the version tables follow.

Structured Streaming keeps track of what has been read (its checkpoint takes the place of a list of work done), so a
run that is stopped goes on where it was. Each batch rewrites the laws it touches, as a whole and repeatably.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.versions import build_snapshot
from ..sources.stored import intermediates, stored


def follow(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, files_per_batch: int = 64) -> StreamingQuery:
    """Reads what is new under ``source`` and brings ``target`` (one folder a law) up to date; ends when all is read.

    Rows have abbrev, fassung_vom, section_id, heading, body, section_type, arrival. ``target`` holds the kept row of
    each version and section.
    """

    def merge(batch: DataFrame, _: int) -> None:
        laws = batch.select("abbrev").distinct()
        with intermediates():
            try:
                # read eagerly into a stored copy: the folders read are those overwritten below
                before = stored(spark.read.schema(batch.schema).parquet(target).join(laws, "abbrev", "left_semi"))
                rows = before.unionByName(batch)
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                rows = batch
            build_snapshot(rows).write.partitionBy("abbrev").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.where(F.col("abbrev").isNotNull()).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_writes(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """Per law and day of loading, how many section rows came in; rows later than ``late`` are dropped by watermark.

    ``stream`` has gsn and geladen_am.
    """
    timed = stream.where("geladen_am is not null").withColumn("at", F.col("geladen_am").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 day"), "gsn").agg(F.count("*").alias("rows"))
