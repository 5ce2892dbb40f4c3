"""Deeply nested records as related flat tables, by Dewey labels.

Every node of a record gets the path of ordinals that leads to it ("2.1.3": third child of the first child of the
second child of the root). The parent's label is the label without its last ordinal, so the links between the tables
need neither generated keys nor joins. Nodes with one schema path (the names along the way) form one table.

``shred_array_levels`` does this for arrays of structs inside the JVM, ``shred_xml`` for XML text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

XML_NODES = "rec_id bigint, dewey string, parent_dewey string, schema_path string, name string, attrs map<string,string>, text string, tail string"


def parent_label(dewey: Column, levels: int = 1) -> Column:
    """The label of the node ``levels`` above; the empty string is the record itself."""
    return F.regexp_replace(dewey, f"(^|\\.)\\d+(\\.\\d+){{{levels - 1}}}$", "")


def shred_array_levels(df: DataFrame, rec_id: str, levels: Sequence[str]) -> list[DataFrame]:
    """One table per level of nested arrays of structs: rec_id, dewey, parent_dewey, no and the struct's other fields.

    ``levels`` names the array columns from the outside in, e.g. ``["body_blocks", "items"]``. Positions count from 1
    over all stored elements; a null element gives a row with null fields, a null or empty array none. Columns of ``df``
    other than these are not read, so clashing names cannot arise.
    """
    tables = []
    outer = df.select(F.col(rec_id).alias("rec_id"), F.lit("").alias("dewey"), F.col(levels[0]).alias("_kids"))
    for k in range(len(levels)):
        at = outer.select("rec_id", F.col("dewey").alias("_around"), F.posexplode("_kids").alias("_pos", "_node"))
        at = at.withColumn("no", (F.col("_pos") + 1).cast("int"))
        at = at.withColumn("dewey", F.concat_ws(".", F.when(F.col("_around") != "", F.col("_around")), F.col("no").cast("string")))
        below = levels[k + 1] if k + 1 < len(levels) else None
        fields = [f for f in at.schema["_node"].dataType.fieldNames() if f != below]
        tables.append(at.select("rec_id", "dewey", parent_label(F.col("dewey")).alias("parent_dewey"), "no", *(F.col("_node")[f].alias(f) for f in fields)))
        if below:
            outer = at.select("rec_id", "dewey", F.col("_node")[below].alias("_kids"))
    return tables


def xml_nodes(text: str, wanted: frozenset[str] | None = None) -> list[tuple[str, str, str, dict, str, str]] | None:
    """(dewey, schema path, local name, attributes, all text inside, text after) in document order; None if malformed.

    With ``wanted`` only elements of these local names are returned; their labels still count all elements. Attribute
    names lose their namespace. An element's text holds the text of everything inside, in order.
    """
    out: list[list] = []
    counts, labels, names, open_at = [0], [], [], []
    buffers: list[list[str]] = []
    last_closed: list[int | None] = [None]

    def start(tag: str, attrs: dict) -> None:
        counts[-1] += 1
        labels.append(f"{labels[-1]}.{counts[-1]}" if labels else str(counts[-1]))
        counts.append(0)
        name = tag.rpartition("}")[2]
        names.append(name)
        last_closed.append(None)
        if wanted is None or name in wanted:
            open_at.append(len(out))
            out.append([labels[-1], "/".join(names), name, {k.rpartition("}")[2]: v for k, v in attrs.items()}, "", ""])
            buffers.append([])
        else:
            open_at.append(-1)

    def end(tag: str) -> None:
        at = open_at.pop()
        if at >= 0:
            out[at][4] = "".join(buffers.pop())
            if buffers:
                buffers[-1].append(out[at][4])
        counts.pop()
        labels.pop()
        names.pop()
        last_closed.pop()
        if last_closed:
            last_closed[-1] = at

    def chars(data: str) -> None:
        if buffers:
            buffers[-1].append(data)
        if (at := last_closed[-1]) is not None and at >= 0:
            out[at][5] += data

    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
    try:
        parser.Parse(text, True)
    except (expat.ExpatError, ValueError):
        return None
    return [tuple(x) for x in out]


def shred_xml(df: DataFrame, rec_id: str, xml: str, wanted: Sequence[str] | None = None) -> DataFrame:
    """Every element of every well-formed record as a row (``XML_NODES``).

    Malformed, empty and null XML give no rows. The parent label is the label cut by one; ``schema_path`` tells the
    flat table a node belongs to. ``wanted`` keeps elements of these local names only.
    """
    keep = frozenset(wanted) if wanted is not None else None
    schema = pa.schema([("rec_id", pa.int64()), *((c, pa.string()) for c in ("dewey", "parent_dewey", "schema_path", "name")), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("tail", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rec, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                for d, path, name, attrs, inside, tail in xml_nodes(text, keep) or ():
                    rows.append({"rec_id": rec, "dewey": d, "parent_dewey": d.rpartition(".")[0], "schema_path": path, "name": name, "attrs": list(attrs.items()), "text": inside, "tail": tail})
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return df.where(F.col(xml) != "").select(F.col(rec_id).cast("long"), F.col(xml)).mapInArrow(run, XML_NODES)


def tables_by_path(nodes: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """For each element name the flat table of its nodes (rows of ``shred_xml``), whatever path they stand at.

    rec_id, dewey, parent_dewey, schema_path, the attributes, and the text. Children point to their parent's row by
    rec_id and parent_dewey, the label without its last ordinal.
    """
    return {n: nodes.where(F.col("name") == n).select("rec_id", "dewey", parent_label(F.col("dewey")).alias("parent_dewey"), "schema_path", "attrs", "text") for n in names}


def numbered_descendants(df: DataFrame, rec_id: str, xml: str, name: str, attribute: str, value: str) -> DataFrame:
    """rec_id, dewey, child_no, parent_no of the elements ``name`` whose ``attribute`` is ``value``.

    child_no counts them in document order from 1 within the record. parent_no is the number of the nearest one around
    it, found by cutting the label until it is the label of such an element, else 0. Malformed XML gives no rows.
    """
    keep = frozenset([name])
    schema = pa.schema([("rec_id", pa.int64()), ("dewey", pa.string()), ("child_no", pa.int32()), ("parent_no", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: tuple[list, list, list, list] = ([], [], [], [])
            for rec, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                number: dict[str, int] = {}
                for dewey, _, _, attrs, _, _ in xml_nodes(text, keep) or ():
                    if attrs.get(attribute) != value:
                        continue
                    number[dewey] = no = len(number) + 1
                    up = dewey
                    while up and (up := up.rpartition(".")[0]) and up not in number:
                        pass
                    for c, v in zip(cols, (rec, dewey, no, number.get(up, 0)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)

    # a record without the attribute's value or the element's name cannot have such an element
    text = F.col(xml)
    return df.where(text.contains(name)).select(F.col(rec_id).cast("long"), text).mapInArrow(run, "rec_id bigint, dewey string, child_no int, parent_no int")
