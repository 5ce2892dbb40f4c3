"""Provision XML parsed into sections: heading, body blocks, body, id and type.

A document becomes its table of nodes (``shred.xml_nodes``), and a node's place decides what it contributes: the path
from ``nutzdaten`` to it, ``abschnitt`` elements left out, is looked up in ``PLACES``. Only nodes with ``ct="text"``
contribute text, so blocks that describe the document stay out. Arrow batches of records go through one parser pass
each; the text functions afterwards stay in the JVM. Records that are malformed, have no ``nutzdaten`` or no block give
no row (``outcomes`` tells which). Namespaces don't matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.law_text import derive_section_id, derive_section_type, render_blocks
from .shred import xml_nodes

# List elements and the style of their list; of "aufzaehlung" the first symbol decides.
STYLES = {
    "aufzaehlung": "ordered",
    "ziffernliste": "ordered",
    "literaliste": "letters",
    "subliteraliste": "letters",
    "betragliste": "amounts",
    "strichliste": "dash",
    "erlliste": "letters",
    "betraglistetgue": "letters",
}
# Elements that are a block of text.
TEXTS = {"absatz", "listelem", "schlussteil", "beschr"}
# Further elements that are known and hold no block of their own.
KNOWN_OTHERS = {
    "kzinhalt", "fzinhalt", "abstand", "gldsym", "symbol", "tab", "feld", "span", "i", "b", "u", "sub", "link", "br", "gdash", "gs", "n", "nbsp", "schluss", "super", "table",
    "td", "tr", "binary", "src", "inhaltsvz", "bdash", "amp", "lt", "gt", "pdeinst", "pdvorlage", "aw", "en", "s", "ueberschrift", "liste", "abschnitt", "nutzdaten",
}
KNOWN = set(STYLES) | TEXTS | KNOWN_OTHERS
#: Inside a ``liste`` an "erlliste" has no place of its own.
INNER = {x for x in STYLES if x != "erlliste"}
#: What a node is by its path below ``nutzdaten`` without the sections around it.
PLACES = [
    ("heading", re.compile("ueberschrift")),
    ("text", re.compile("|".join(sorted(TEXTS)))),
    ("list", re.compile("|".join(STYLES))),
    ("inner list", re.compile(f"(liste/)+({'|'.join(sorted(INNER))})")),
    ("closing", re.compile("(liste/)+schlussteil")),
]
BLOCKS = "array<struct<type:string,text:string,style:string,items:array<struct<symbol:string,text:string>>>>"
_ITEM = pa.struct([("symbol", pa.string()), ("text", pa.string())])
_BLOCK = pa.struct([("type", pa.string()), ("text", pa.string()), ("style", pa.string()), ("items", pa.list_(_ITEM))])
MALFORMED, NO_DATA, NO_BLOCK, SECTION = "malformed", "no data", "no block", "section"


class Document:
    """The nodes inside ``nutzdaten`` of one document, by label and by parent."""

    def __init__(self, nodes: list[tuple]) -> None:
        top = nodes[0]
        data = top if top[2] == "nutzdaten" else next((n for n in nodes if n[2] == "nutzdaten" and n[0].count(".") == 1), None)
        self.found = data is not None
        self.nodes = [n for n in nodes if n[0].startswith(data[0] + ".")] if data else []
        self.depth = len(data[1]) + 1 if data else 0
        self.children: dict[str, list[tuple]] = defaultdict(list)
        for n in self.nodes:
            self.children[n[0].rpartition(".")[0]].append(n)

    def child(self, label: str, name: str) -> tuple | None:
        return next((n for n in self.children[label] if n[2] == name), None)

    def place(self, node: tuple) -> str | None:
        path = node[1][self.depth :]
        while path.startswith("abschnitt/"):
            path = path[len("abschnitt/") :]
        return next((what for what, pattern in PLACES if pattern.fullmatch(path)), None)

    def style(self, node: tuple) -> str:
        first = self.child(node[0], "listelem") if node[2] == "aufzaehlung" else None
        symbol = self.child(first[0], "symbol") if first else None
        return "letters" if symbol and re.fullmatch("[a-z]+", symbol[4].strip().lower().rstrip(".)")) else STYLES[node[2]]

    def items(self, node: tuple, inner: bool) -> list[dict]:
        """Symbol and text of a list's elements; inside a ``liste`` white space before the symbol keeps it in the text."""
        out = []
        for n in self.children[node[0]]:
            if n[2] == "listelem" and n[3].get("ct") == "text":
                symbol = self.child(n[0], "symbol")
                mark = symbol[4] if symbol else ""
                out.append({"symbol": mark, "text": (n[4] if inner else n[4].strip()).removeprefix(mark).strip()})
        return out

    def read(self) -> tuple[str, str, list[dict]]:
        """(heading, first symbol, blocks)."""
        headings, symbols = [], []
        blocks: list[tuple[tuple, dict]] = []  # with the place in the document's order
        closings: dict[tuple, list[dict]] = defaultdict(list)
        for n in self.nodes:
            what, text = self.place(n), n[4].strip()
            if what is None:
                continue
            at = tuple(map(int, n[0].split(".")))
            if what in ("list", "inner list"):
                if items := self.items(n, what == "inner list"):
                    blocks.append((at, {"type": "list", "text": None, "style": self.style(n), "items": items}))
            elif n[3].get("ct") != "text" or not text:
                continue
            elif what == "heading":
                headings += [text] if n[3].get("typ") != "titel" else []
            elif what == "text":
                blocks.append((at, {"type": "text", "text": text, "style": None, "items": None}))
                if n[2] == "absatz" and (mark := self.child(n[0], "gldsym")):
                    symbols.append(mark[4].strip())
            else:
                # closing parts are one block before the next list of their ``liste``, else at its end
                later = (m for m in self.children[n[0].rpartition(".")[0]] if m[2] in INNER and int(m[0].rpartition(".")[2]) > at[-1])
                follower = next(later, None)
                stop = int(follower[0].rpartition(".")[2]) - 0.5 if follower else float("inf")
                closings[(*at[:-1], stop)].append({"symbol": None, "text": text})
        blocks += [(at, {"type": "list", "text": None, "style": "schluss", "items": items}) for at, items in closings.items()]
        return " ".join(headings), next((s for s in symbols if s), ""), [b for _, b in sorted(blocks, key=lambda x: x[0])]


def read_section(text: str | None) -> tuple[str, tuple[str, str, list[dict]] | None]:
    """(outcome, (heading, first symbol, blocks) or None) of one document."""
    nodes = xml_nodes(text) if text else None
    if not nodes:
        return MALFORMED if text else NO_DATA, None
    document = Document(nodes)
    if not document.found:
        return NO_DATA, None
    read = document.read()
    return (SECTION, read) if read[2] else (NO_BLOCK, None)


_READ = pa.schema([("rec_id", pa.int64()), ("apa", pa.string()), ("outcome", pa.string()), ("heading", pa.string()), ("symbol", pa.string()), ("body_blocks", pa.list_(_BLOCK))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for rec, apa, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            outcome, read = read_section(text)
            rows.append((rec, apa, outcome, *(read or (None, None, None))))
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(_READ), _READ, strict=True)], schema=_READ)


def _documents(df: DataFrame, rec_id: str, xml: str, apa: str | None) -> DataFrame:
    read = df.select(F.col(rec_id).cast("long").alias("rec_id"), (F.col(apa) if apa else F.lit(None).cast("string")).alias("apa"), F.col(xml).alias("xml"))
    return read.mapInArrow(_read, f"rec_id long, apa string, outcome string, heading string, symbol string, body_blocks {BLOCKS}")


def parse_sections(df: DataFrame, rec_id: str = "xml_id", xml: str = "nutzdaten", apa: str = "apa") -> DataFrame:
    """rec_id, section_id, heading, body, body_blocks, section_type of every record that has a section."""
    read = _documents(df.where(F.col(xml) != ""), rec_id, xml, apa).where(F.col("outcome") == SECTION)
    read = read.withColumn("body", render_blocks(F.col("body_blocks")))
    return read.select("rec_id", derive_section_id(F.col("apa"), F.col("symbol"), F.col("heading"), F.col("body")).alias("section_id"), "heading", "body", "body_blocks", derive_section_type(F.col("apa"), F.col("heading")).alias("section_type"))


def outcomes(df: DataFrame, rec_id: str = "xml_id", xml: str = "nutzdaten") -> DataFrame:
    """rec_id, outcome of every record: section, no block, no data or malformed."""
    return _documents(df, rec_id, xml, None).select("rec_id", "outcome")


def unknown_tags(df: DataFrame, rec_id: str = "xml_id", xml: str = "nutzdaten") -> DataFrame:
    """tag, n_records: element names inside ``nutzdaten`` that the parser has no rule for, and in how many records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags: list[str] = []
            for text in batch[0].to_pylist():
                tags += sorted({n[2] for n in Document(nodes).nodes} - KNOWN) if (nodes := xml_nodes(text)) else []
            yield pa.RecordBatch.from_arrays([pa.array(tags, pa.string())], names=["tag"])

    return df.where(F.col(xml) != "").select(F.col(xml).alias("xml")).mapInArrow(run, "tag string").groupBy("tag").agg(F.count("*").alias("n_records"))


def newest_documents(records: DataFrame) -> DataFrame:
    """One row a nor_id of raw records (xml_id, nor_id, apa, nutzdaten, abgerufen_am): the one fetched last; null nor_id are left out."""
    fetched = F.struct(F.col("abgerufen_am"), F.col("xml_id"))
    kept = records.where("nor_id is not null").groupBy("nor_id").agg(F.max_by(F.struct("xml_id", "apa", "nutzdaten"), fetched).alias("d"))
    return kept.select("nor_id", "d.*")


def sections_of_index(index: DataFrame, records: DataFrame) -> DataFrame:
    """abbrev, fassung_vom, nor_id, arrival, outcome and the parsed section of every document a version's index names.

    ``index``: abbrev, fassung_vom, nor_id, arrival. Each document is parsed once, however many versions name it; a
    document that was never fetched has the outcome "not fetched". The rows with outcome "section" and a body make the
    version (``versions.build_snapshot``), the others are the errors of its run.
    """
    documents = newest_documents(records)
    parsed = documents.select("nor_id", "xml_id").join(outcomes(documents), F.col("xml_id") == F.col("rec_id")).select("nor_id", "xml_id", "outcome")
    sections = parse_sections(documents).withColumnRenamed("rec_id", "xml_id")
    full = parsed.join(sections, "xml_id", "left")
    rows = index.where("nor_id is not null").join(full, "nor_id", "left")
    return rows.select("abbrev", "fassung_vom", "nor_id", "arrival", F.coalesce("outcome", F.lit("not fetched")).alias("outcome"), "section_id", "heading", "body", "body_blocks", "section_type")
