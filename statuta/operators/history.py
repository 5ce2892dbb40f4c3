"""The history of attributes that change over time, kept as checkpoints and patches.

Of dated snapshots, every ``every``-th one of an owner (a law) is stored in full: its checkpoint. For each snapshot in
between only patches are stored: entity, attribute, new value, or the entity's removal. Validity rows come from
folding the patches forward from the nearest checkpoint. One stretch from a checkpoint to the next is a unit of work
of its own, so that an owner or entity with very many snapshots is spread over many tasks; the runs that meet at a
checkpoint are joined afterwards, when only changes are left.

Nulls: a snapshot row with a null owner, date or entity belongs to no snapshot. Null attributes are values like any
other (equal to each other). Repeated rows of one entity at one date count once (the greatest value is taken).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored

OPEN_END = "9999-12-31"


def snapshot_dates(rows: DataFrame, owner: str, date: str) -> DataFrame:
    """owner, date, seq (from 0), next_date, prev_date of each snapshot. Windows see one row a snapshot."""
    w = Window.partitionBy(owner).orderBy(date)
    return (
        rows.select(owner, date).where(F.col(owner).isNotNull() & F.col(date).isNotNull()).distinct()
        .withColumns({"seq": F.row_number().over(w) - 1, "next_date": F.lead(date).over(w), "prev_date": F.lag(date).over(w)})
    )


@dataclass(frozen=True)
class DeltaStore:
    """checkpoints: owner, epoch, seq, entity, value. patches: owner, epoch, seq, entity, value, removed. dates: see above."""

    checkpoints: DataFrame
    patches: DataFrame
    dates: DataFrame
    owner: str
    entity: str
    value: str
    date: str
    every: int

    @classmethod
    def build(cls, rows: DataFrame, owner: str, entity: str, value: str, date: str, every: int = 16) -> DeltaStore:
        """The store of the snapshots in ``rows``, a checkpoint at every ``every``-th snapshot of an owner."""
        rows = stored(rows.select(owner, entity, value, date))
        dates = stored(snapshot_dates(rows, owner, date))
        last = Window.partitionBy(owner)
        at = dates.select(owner, date, "seq", F.max("seq").over(last).alias("last_seq"))
        full = (
            rows.where(F.col(owner).isNotNull() & F.col(date).isNotNull() & F.col(entity).isNotNull())
            .groupBy(owner, date, entity).agg(F.max(value).alias(value))
            .join(at, [owner, date])
            .select(owner, F.floor(F.col("seq") / every).cast("int").alias("epoch"), "seq", "last_seq", entity, value)
        )
        # within a stretch: a patch where the value differs from the one before or the entity was absent before,
        # a removal where it is absent from the next snapshot of the stretch
        w = Window.partitionBy(owner, entity, "epoch").orderBy("seq")
        steps = full.withColumns({"_was": F.lag("seq").over(w), "_had": F.lag(value).over(w), "_then": F.lead("seq").over(w)})
        is_checkpoint = F.col("seq") % every == 0
        changed = ~is_checkpoint & (F.col("_was").isNull() | (F.col("_was") < F.col("seq") - 1) | ~F.col(value).eqNullSafe(F.col("_had")))
        end = F.least(F.col("last_seq"), (F.col("epoch") + 1) * every - 1)
        gone = (F.col("seq") < end) & (F.col("_then").isNull() | (F.col("_then") > F.col("seq") + 1))
        events = F.array_compact(F.array(
            F.when(is_checkpoint | changed, F.struct(is_checkpoint.alias("checkpoint"), F.col("seq").alias("seq"), F.col(value).alias(value), F.lit(False).alias("removed"))),
            F.when(gone, F.struct(F.lit(False).alias("checkpoint"), (F.col("seq") + 1).alias("seq"), F.lit(None).cast(full.schema[value].dataType).alias(value), F.lit(True).alias("removed"))),
        ))
        kept = steps.select(owner, "epoch", entity, F.explode(events).alias("e")).select(owner, "epoch", entity, "e.*")
        kept = stored(kept)
        return cls(kept.where("checkpoint").drop("checkpoint"), kept.where("not checkpoint").drop("checkpoint"), dates, owner, entity, value, date, every)

    def validity(self) -> DataFrame:
        """owner, entity, value, valid_from, valid_to: the longest runs of consecutive snapshots with one value.

        Folds the patches of each stretch forward from its checkpoint, then joins equal runs that meet at a checkpoint.
        """
        o, e, v = self.owner, self.entity, self.value
        events = self.checkpoints.unionByName(self.patches)
        fold = Window.partitionBy(o, e, "epoch").orderBy("seq")
        runs = events.withColumn("until", F.lead("seq").over(fold)).where("not removed")
        # a run open at the end of its stretch reaches the next checkpoint, if there is one
        stops = self.dates.groupBy(o, F.floor(F.col("seq") / self.every).cast("int").alias("epoch")).agg((F.max("seq") + 1).alias("_stop"))
        runs = runs.join(stops, [o, "epoch"]).select(o, e, v, "seq", F.coalesce("until", "_stop").alias("until"))
        w = Window.partitionBy(o, e).orderBy("seq")
        met = F.lag("until").over(w).eqNullSafe(F.col("seq")) & F.lag(v).over(w).eqNullSafe(F.col(v))
        runs = runs.withColumn("_new", F.when(met, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
        runs = runs.groupBy(o, e, "_run").agg(F.first(v).alias(v), F.min("seq").alias("seq"), F.max("until").alias("until"))
        begin = self.dates.select(o, "seq", F.col(self.date).alias("valid_from"))
        stop = self.dates.select(o, (F.col("seq") + 1).alias("until"), F.coalesce("next_date", F.lit(OPEN_END)).alias("valid_to"))
        return runs.join(begin, [o, "seq"]).join(stop, [o, "until"]).select(o, e, v, "valid_from", "valid_to")

    def as_of(self, seq: Column | int) -> DataFrame:
        """owner, entity, value at snapshot ``seq`` of each owner: its checkpoint with the patches up to there."""
        o, e, v = self.owner, self.entity, self.value
        seq = F.lit(seq) if isinstance(seq, int) else seq
        events = self.checkpoints.unionByName(self.patches).where((F.col("epoch") == F.floor(seq / self.every)) & (F.col("seq") <= seq))
        last = events.groupBy(o, e).agg(F.max_by(F.struct(F.col(v).alias(v), "removed"), "seq").alias("_l"))
        return last.where("not _l.removed").select(o, e, F.col(f"_l.{v}").alias(v))
