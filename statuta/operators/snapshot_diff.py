"""What changed between consecutive full snapshots, by Merkle trees over hash ranges.

The entity keys of an owner's snapshots fall into ranges of their hash, the leaves: as many (a power of ``FAN``) as give
``ROWS_A_LEAF`` rows a leaf in the owner's largest snapshot. The digest of a range is the exclusive or of two row hashes
of 64 bits each, so it comes from partial aggregates, and the digest of a higher range from those below it. The leaf
digests of a snapshot are packed into one row (one row for each ``FAN ** PACKED`` leaves, however large the snapshot
is); that row meets the row of the snapshot before, and the trees above both are compared from the top: only children
of ranges that differ are looked at. Rows are compared one by one in leaves that differ only.

Nulls: rows with a null owner, date or entity belong to no snapshot; a null value is a value. Repeated rows of one
entity at one date count once (the greatest value is taken). A first snapshot has nothing to be compared with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored

FAN = 4
ROWS_A_LEAF = 4
#: Levels of the tree below one packed row; a row has at most FAN ** PACKED leaves.
PACKED = 6


def differing_leaves(depth: int, now: tuple[np.ndarray, np.ndarray, np.ndarray], before: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The leaves whose digests differ in two trees of ``depth`` levels, each given by (leaf, digest, digest) of the leaves not empty."""
    n = FAN**depth
    trees = []
    for leaf, d1, d2 in (now, before):
        level = np.zeros((2, n), np.int64)
        level[0, leaf], level[1, leaf] = d1, d2
        levels = [level]
        while level.shape[1] > 1:
            level = np.bitwise_xor.reduce(level.reshape(2, -1, FAN), axis=2)
            levels.append(level)
        trees.append(levels)
    asked = np.zeros(1, np.int64)
    for a, b in zip(reversed(trees[0]), reversed(trees[1]), strict=True):
        asked = asked[(a[:, asked] != b[:, asked]).any(axis=0)]
        if a.shape[1] < n:
            asked = (asked[:, None] * FAN + np.arange(FAN)).ravel()
    return asked


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """owner, at, branch, depth (of the tree above the packed row) and the two packed rows to owner, at, leaf."""
    for batch in batches:
        depth, branch = batch.column("depth").to_pylist(), batch.column("branch").to_pylist()
        sides = []
        for side in ("now", "before"):
            lists = batch.column(side)
            flat = lists.flatten()
            ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0), np.int64))])
            sides.append((ends, *(np.asarray(flat.field(k)) for k in ("leaf", "d1", "d2"))))
        found, at = [], []
        for k in range(batch.num_rows):
            trees = [tuple(x[ends[k] : ends[k + 1]] for x in cols) for ends, *cols in sides]
            leaves = differing_leaves(depth[k], *trees)
            found.append(leaves + branch[k] * FAN ** depth[k])
            at.append(np.full(len(leaves), k))
        index = pa.array(np.concatenate(at) if at else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("owner").take(index), batch.column("at").take(index), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], names=["owner", "at", "leaf"])


def changes(rows: DataFrame, owner: str, date: str, entity: str, value: str) -> DataFrame:
    """owner, date, entity, change_kind (added, removed, changed) for each difference from the owner's snapshot before."""
    owner_type = rows.schema[owner].dataType
    rows = rows.where(F.col(owner).isNotNull() & F.col(date).isNotNull() & F.col(entity).isNotNull())
    rows = stored(rows.groupBy(F.col(owner).cast("string").alias("owner"), F.col(date).alias("date"), F.col(entity).alias("entity")).agg(F.max(value).alias("v")))
    # one row a snapshot in these windows
    of_owner = Window.partitionBy("owner")
    dates = rows.groupBy("owner", "date").agg(F.count("*").alias("n")).withColumns({"seq": F.row_number().over(of_owner.orderBy("date")), "last": F.count("*").over(of_owner), "most": F.max("n").over(of_owner)})
    depth = F.greatest(F.lit(0), F.ceil(F.log(F.col("most") / ROWS_A_LEAF) / F.log(F.lit(float(FAN))))).cast("int")
    dates = stored(dates.select("owner", "date", "seq", "last", depth.alias("depth")))
    by_hash = F.xxhash64("entity")
    leaf = F.shiftrightunsigned(by_hash, 1) % F.pow(F.lit(FAN), F.col("depth")).cast("long")
    # these tables grow with the data and shrink in files, so their size there says little: no broadcasts
    placed = rows.join(dates.where("last > 1").hint("merge"), ["owner", "date"]).select("owner", "seq", "last", "depth", "entity", "v", leaf.alias("leaf"))
    digest = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "entity", F.col("v").isNull(), "v"))
    leaves = placed.groupBy("owner", "seq", "last", "depth", "leaf").agg(digest(1).alias("d1"), digest(2).alias("d2"))
    # each snapshot is the later side of one comparison and the earlier side of the next one
    packed = F.pow(F.lit(FAN), F.least("depth", F.lit(PACKED))).cast("long")
    node = F.struct((F.col("leaf") % packed).cast("int").alias("leaf"), "d1", "d2")
    sides = F.array_compact(F.array(F.when(F.col("seq") > 1, F.struct(F.col("seq").alias("at"), F.lit(True).alias("now"))), F.when(F.col("seq") < F.col("last"), F.struct((F.col("seq") + 1).alias("at"), F.lit(False).alias("now")))))
    sided = leaves.select("owner", F.least("depth", F.lit(PACKED)).alias("depth"), F.floor(F.col("leaf") / packed).alias("branch"), node.alias("node"), F.explode(sides).alias("s")).select("owner", "depth", "branch", "node", "s.*")

    def one_side(which: Column) -> Column:
        return F.collect_list(F.when(which, F.col("node")))

    trees = sided.groupBy("owner", "at", "branch", "depth").agg(one_side(F.col("now")).alias("now"), one_side(~F.col("now")).alias("before"))
    differ = stored(trees.mapInArrow(_compare, "owner string, at int, leaf long"))
    asked = differ.select("owner", "at", "leaf", F.explode(F.array(F.struct(F.col("at").alias("seq"), F.lit(True).alias("now")), F.struct((F.col("at") - 1).alias("seq"), F.lit(False).alias("now")))).alias("s")).select("owner", "at", "leaf", "s.*")
    met = placed.select("owner", "seq", "leaf", "entity", F.struct("v").alias("v")).join(asked.hint("merge"), ["owner", "seq", "leaf"])
    pairs = met.groupBy("owner", "at", "entity").agg(F.max(F.when(F.col("now"), F.col("v"))).alias("new"), F.max(F.when(~F.col("now"), F.col("v"))).alias("old"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~F.col("new").eqNullSafe(F.col("old")), "changed")
    out = pairs.select("owner", F.col("at").alias("seq"), "entity", kind.alias("change_kind")).where("change_kind is not null")
    return out.join(dates.select("owner", "seq", "date"), ["owner", "seq"]).select(F.col("owner").cast(owner_type).alias(owner), F.col("date").alias(date), F.col("entity").alias(entity), "change_kind")
