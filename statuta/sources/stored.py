"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL = threading.local()


def _open() -> list[list[DataFrame]]:
    """The tables stored within each ``intermediates`` of this thread that is not at its end."""
    if not hasattr(_LOCAL, "open"):
        _LOCAL.open = []
    return _LOCAL.open


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one of this machine in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="statuta-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once and read back: it cuts the lineage, survives lost executors and has a known size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    if _open():
        _open()[-1].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a table from ``stored``, once everything made of it is stored itself."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def intermediates() -> Iterator[None]:
    """Deletes at its end the tables stored within; results must be written or collected inside."""
    _open().append([])
    try:
        yield
    finally:
        for df in _open().pop():
            discard(df)
