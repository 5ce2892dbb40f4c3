"""A paged document API as a Spark data source: ``spark.read.format("paged_documents")``.

Options: ``url`` (the service), ``keys`` (JSON list of request parameters, one object a scan, e.g. one law at one
date), ``pages`` (pages at most a scan; default 10000), ``pause`` (seconds between requests of a task; default 0.2),
``attempts`` (default 4). Each scan is one partition, so scans run in parallel and a lost one is repeated alone. Pages
are asked for until the number of hits is reached; a reply without results ends the scan.

A crawl of very many pages sets ``range`` (pages a partition): then a scan is cut into ranges of pages. A page that
fails is passed over, and a range ends where the hits end or after ``dry`` pages (default 200) without a row.
``at_once`` (default 5) bounds the requests at a time: partitions are grouped into so many tasks, each of which sends
one request after another.

The columns are those of an index row. ``documents_of`` reads replies already on disk by the same rules.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

INDEX_ROW = "nor_id string, apa string, typ string, inkrafttretensdatum string, titel string, gsn string, abbrev string, name string, kundmachungsorgan string"
# Where the fields are in a document reference of a reply.
PATHS = {
    "nor_id": ("Data", "Metadaten", "Technisch", "ID"),
    "apa": ("Data", "Metadaten", "Bundesrecht", "BrKons", "ArtikelParagraphAnlage"),
    "typ": ("Data", "Metadaten", "Bundesrecht", "BrKons", "Typ"),
    "inkrafttretensdatum": ("Data", "Metadaten", "Bundesrecht", "BrKons", "Inkrafttretensdatum"),
    "titel": ("Data", "Metadaten", "Bundesrecht", "BrKons", "Titel"),
    "gsn": ("Data", "Metadaten", "Bundesrecht", "BrKons", "Gesetzesnummer"),
    "abbrev": ("Data", "Metadaten", "Bundesrecht", "BrKons", "Abkuerzung"),
    "name": ("Data", "Metadaten", "Bundesrecht", "Kurztitel"),
    "kundmachungsorgan": ("Data", "Metadaten", "Bundesrecht", "BrKons", "Kundmachungsorgan"),
}
REFERENCES = ("OgdSearchResult", "OgdDocumentResults", "OgdDocumentReference")
HITS = ("OgdSearchResult", "OgdDocumentResults", "Hits")


def dig(value: object, path: tuple[str, ...], default: object = "") -> object:
    """What lies at a path of a nested reply, else the default."""
    for step in path:
        if not isinstance(value, dict) or step not in value:
            return default
        value = value[step]
    return value


def rows_of_reply(reply: dict) -> tuple[list[tuple], bool]:
    """The index rows of a reply, and whether it is the last page. References that aren't objects are passed over."""
    refs = dig(reply, REFERENCES, None)
    if refs is None:
        return [], True
    rows = [tuple(str(dig(r, p) or "") for p in PATHS.values()) for r in (refs if isinstance(refs, list) else [refs]) if isinstance(r, dict)]
    hits = dig(reply, HITS, {})
    total, size, page = (int(dig(hits, (k,), d) or d) for k, d in (("#text", 0), ("@pageSize", 100), ("@pageNumber", 1)))
    return rows, page * size >= total


class Scans(InputPartition):
    """Scans that one task makes in turn: (parameters, first page, last page)."""

    def __init__(self, scans: list[tuple[dict[str, str], int, int]]) -> None:
        self.scans = scans


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.url = options["url"]
        self.keys = json.loads(options["keys"])
        self.most, self.pause, self.attempts = int(options.get("pages", 10_000)), float(options.get("pause", 0.2)), int(options.get("attempts", 4))
        self.range, self.dry, self.at_once = int(options.get("range", 0)), int(options.get("dry", 200)), int(options.get("at_once", 5))

    def partitions(self) -> list[Scans]:
        width = self.range or self.most
        scans = [(k, first, min(first + width - 1, self.most)) for k in self.keys for first in range(1, self.most + 1, width)]
        return [Scans(scans[k :: self.at_once]) for k in range(min(self.at_once, len(scans)))]

    def ask(self, parameters: dict[str, str]) -> dict:
        """One request; failed ones are repeated after 1, 2, 4 ... seconds."""
        body = urllib.parse.urlencode(parameters).encode()
        for k in range(self.attempts):
            try:
                time.sleep(self.pause)
                with urllib.request.urlopen(urllib.request.Request(self.url, data=body), timeout=60) as reply:  # noqa: S310
                    return json.load(reply)
            except OSError:
                if k == self.attempts - 1:
                    raise
                time.sleep(2**k)
        return {}

    def read(self, partition: Scans) -> Iterator[tuple]:
        for parameters, first, last in partition.scans:
            dry = 0
            for page in range(first, last + 1):
                try:
                    rows, at_end = rows_of_reply(self.ask(parameters | {"Seitennummer": str(page), "DokumenteProSeite": "OneHundred"}))
                except (OSError, ValueError):
                    if not self.range:
                        raise
                    rows, at_end = [], False  # a crawl goes on with the next page
                yield from rows
                dry = 0 if rows else dry + 1
                if at_end or dry > self.dry:
                    break


class PagedDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_documents"

    def schema(self) -> str:
        return INDEX_ROW

    def reader(self, schema: StructType) -> PagedReader:  # noqa: ARG002
        return PagedReader(self.options)


def dated(index: DataFrame) -> DataFrame:
    """The index rows that have an in-force date, which becomes ``fassung_vom``."""
    return index.where(F.col("inkrafttretensdatum") != "").withColumn("fassung_vom", F.col("inkrafttretensdatum"))


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """The index rows of replies kept as JSON files, one reply a file."""
    text = spark.read.text(path, wholetext=True)
    refs = F.from_json(F.get_json_object("value", "$." + ".".join(REFERENCES)), "array<string>")
    one = text.select(F.explode(refs).alias("r"))

    def field(path: tuple[str, ...]) -> Column:
        return F.coalesce(F.get_json_object("r", "$." + ".".join(path)), F.lit(""))

    return one.select(*(field(p).alias(k) for k, p in PATHS.items()))
