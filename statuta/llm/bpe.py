"""Encoding a corpus with a public byte-level BPE vocabulary.

A piece of text (as the vocabulary's split pattern cuts it) is merged with a segment tree over its byte positions:
leaf i holds the rank of the pair that starts at the live position i, inner nodes the leftmost minimum. Each merge
takes the root's pair, joins the two live neighbours (a linked list) and updates the two leaves that changed, in
logarithmic time; so a piece of n bytes takes O(n log n), however long it is.

Pieces recur, so each worker keeps the ids of pieces it has seen, in a table of bounded size.

Null and empty texts give an empty list. Ids are those of ordinary text; special tokens are never produced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files unless the session's setting ``statuta.tokenizers`` or a function's parameter names another.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
# Fixed value: the split pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 60
#: Pieces and runs a worker remembers; at most about 100 MB.
REMEMBERED = 250_000
#: Longer keys are not remembered.
LONGEST_KEY = 64


class PairTree:
    """Leftmost minimum over positions that change one at a time."""

    def __init__(self, values: list[int]) -> None:
        self.base = base = 1 << max(0, (len(values) - 1).bit_length())
        self.low = low = [_NONE] * base + values + [_NONE] * (base - len(values))
        for i in range(base - 1, 0, -1):
            a, b = low[2 * i], low[2 * i + 1]
            low[i] = a if a <= b else b

    def update(self, i: int, value: int) -> None:
        low = self.low
        i += self.base
        low[i] = value
        i >>= 1
        while i:
            a, b = low[2 * i], low[2 * i + 1]
            m = a if a <= b else b
            if low[i] == m:
                break
            low[i] = m
            i >>= 1

    def leftmost(self) -> int:
        """The first position with the least value."""
        low, base, i = self.low, self.base, 1
        m = low[1]
        while i < base:
            i *= 2
            if low[i] != m:
                i += 1
        return i - base


class Encoder:
    """Ids of texts by a file of ranks; ``remembered`` bounds the table of known pieces."""

    def __init__(self, vocabulary: str = VOCABULARY, folder: str = TOKENIZERS, remembered: int = REMEMBERED) -> None:
        with open(f"{folder}/{vocabulary}.tiktoken", "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(PATTERN)
        # a single space between other characters always begins a piece; texts with other runs of white space around
        # spaces are cut by the pattern as a whole
        self.irregular = regex.compile(r"(?:\A|\s) (?:\s|\Z)|[^ ] \Z|\A\Z|\A ")
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        # end[i]: where the token that starts at i ends; before[i]: where the token before it starts
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = PairTree([ranks.get(piece[i : i + 2], _NONE) for i in range(n - 1)])
        while tree.low[1] < _NONE:
            i = tree.leftmost()
            j = end[i]
            k = end[i] = end[j]
            if j < n - 1:
                tree.update(j, _NONE)
            if k < n:
                before[k] = i
                tree.update(i, ranks.get(piece[i : end[k]], _NONE))
            else:
                tree.update(i, _NONE)
            if (h := before[i]) >= 0:
                tree.update(h, ranks.get(piece[h:k], _NONE))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _ids(self, run: str) -> bytes:
        """The ids of a run of pieces, four bytes each."""
        found = self.known.get(run)
        if found is None:
            ids: list[int] = []
            for piece in self.split.findall(run):
                ids += self.merge(piece.encode("utf-8", "surrogatepass"))
            found = np.asarray(ids, np.int32).tobytes()
            if len(run) <= LONGEST_KEY:
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[run] = found
        return found

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of a text, four bytes each in the machine's order; empty for null and empty texts."""
        if not text:
            return b""
        if self.irregular.search(text):
            runs = self.split.findall(text)
        else:
            first, *rest = text.split(" ")
            runs = [first, *[" " + x for x in rest]]
        known, ids = self.known, self._ids
        return b"".join([known[r] if r in known else ids(r) for r in runs])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str, folder: str) -> Encoder:
    """The worker's encoder of this vocabulary, read once a process."""
    key = (vocabulary, folder)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary, folder)
    return _ENCODERS[key]


def folder_of(df: DataFrame, folder: str | None) -> str:
    return folder or df.sparkSession.conf.get("statuta.tokenizers", TOKENIZERS)


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """doc_id and ids (a list of integers) of every row; other columns are not read. No shuffle."""
    folder = folder_of(df, folder)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, folder)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # whole texts, few at a time: long ones must not pile up
                part = batch.slice(at, 512)
                coded = [enc.encode_bytes(t) for t in part[1].to_pylist()]
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.RecordBatch.from_arrays([part[0], ids], schema=schema)

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(df: DataFrame, *keep: str, text: str = "text", vocabulary: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """The columns ``keep`` and n_tokens of every row; 0 for null and empty texts. No shuffle."""
    folder = folder_of(df, folder)
    chosen = df.select(*keep, F.col(text).alias("_text"))
    out = chosen.drop("_text").withColumn("n_tokens", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, folder)
        for batch in batches:
            n = pa.array([len(enc.encode_bytes(t)) // 4 for t in batch[batch.num_columns - 1].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=[*batch.schema.names[:-1], "n_tokens"])

    return chosen.mapInArrow(run, out)
