"""Mixing sources to target weights, with capped repetition.

Records are aggregated by membership pattern, the set of sources they belong to. A min-cost flow routes the token
capacity of the patterns to the sources' quotas: every further use of a pattern's tokens costs more than the one
before (a convex cost), so that repetition is spread evenly and used only where a quota needs it. A source may use a
pattern's tokens no more often than its cap allows, and a record is used no more often than its most generous source
allows. The flow has a node a pattern and a source, not a record.

Then records are chosen. All records of a pattern lie on a line in seeded random order, one after the other by size;
a flow of f tokens takes the line's first f tokens, going round again for each repetition. A record belongs to the
source in whose stretch its middle falls. The line is cut into buckets by hash, whose totals are summed up first, so
no task orders more than a bucket.

The size of the mixture is the largest one the caps allow, but at most all tokens of the corpus (or ``total``).

Records without a known source, and of null, empty or otherwise 0 tokens, are not used. Sources without a record
contribute nothing; then no mixture has the target shares, and the size is that of the others' quotas. Null shares
count as 0, null caps as 1.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored

BUCKETS = 1024
SEED = 20240501


class Flow:
    """Successive cheapest paths on a small graph."""

    def __init__(self) -> None:
        self.edges: list[list] = []  # to, capacity, cost
        self.out: dict[object, list[int]] = defaultdict(list)

    def add(self, a: object, b: object, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.edges))
        self.edges.append([b, capacity, cost])
        self.out[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def run(self, start: object, goal: object) -> int:
        total = 0
        while True:
            cost, via, queue, waiting = {start: 0}, {}, deque([start]), {start}
            while queue:
                x = queue.popleft()
                waiting.discard(x)
                for e in self.out[x]:
                    to, capacity, c = self.edges[e]
                    if capacity > 0 and cost[x] + c < cost.get(to, 1 << 62):
                        cost[to], via[to] = cost[x] + c, (x, e)
                        if to not in waiting:
                            queue.append(to)
                            waiting.add(to)
            if goal not in cost:
                return total
            amount, x = 1 << 62, goal
            while x != start:
                x, e = via[x]
                amount = min(amount, self.edges[e][1])
            x = goal
            while x != start:
                x, e = via[x]
                self.edges[e][1] -= amount
                self.edges[e ^ 1][1] += amount
            total += amount

    def flow(self, e: int) -> int:
        return self.edges[e ^ 1][1]


def route(patterns: dict[tuple[str, ...], int], shares: dict[str, float], caps: dict[str, int], total: int | None = None) -> tuple[int, dict[tuple[tuple[str, ...], str], int]]:
    """(size, tokens of each pattern for each source) of the largest mixture with the target shares.

    ``patterns`` has the tokens of each set of sources. With ``total`` the mixture is no larger than that.
    """
    live = {s for p, n in patterns.items() if n > 0 for s in p}
    wanted = {s: w for s, w in shares.items() if w > 0 and s in live}
    most = min(sum(patterns.values()), total if total is not None else 1 << 62)

    def attempt(size: int) -> tuple[bool, dict]:
        g, arcs = Flow(), {}
        quotas = {s: int(size * w) for s, w in wanted.items()}
        for p, n in patterns.items():
            mine = [s for s in p if s in wanted]
            # no use beyond the whole mixture is needed, however large a cap is
            for k in range(min(max((caps.get(s, 1) for s in mine), default=0), size // n + 1 if n else 0)):
                g.add("start", ("p", p), n, k)
            for s in mine:
                arcs[p, s] = g.add(("p", p), ("s", s), n * caps.get(s, 1), 0)
        for s, q in quotas.items():
            g.add(("s", s), "goal", q, 0)
        done = g.run("start", "goal") == sum(quotas.values())
        return done, {k: f for k, e in arcs.items() if (f := g.flow(e)) > 0}

    low, high = 0, most
    best = attempt(0)[1]
    while low < high:
        size = (low + high + 1) // 2
        done, flows = attempt(size)
        if done:
            low, best = size, flows
        else:
            high = size - 1
    return low, best


def mix(sized: DataFrame, weights: DataFrame, total: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, times, n_tokens of every record used: for which source, how often, its size.

    ``sized``: doc_id, sources (array), n_tokens, unique in doc_id. ``weights``: source, target_share, max_repeats.
    """
    rows = {r.source: (float(r.target_share or 0), int(r.max_repeats if r.max_repeats is not None else 1)) for r in weights.where("source is not null").select("source", "target_share", "max_repeats").collect()}  # one row a source
    known = F.array(*(F.lit(s) for s in sorted(rows))).cast("array<string>")
    docs = sized.select("doc_id", F.array_sort(F.array_intersect(F.coalesce("sources", known), known)).alias("pattern"), F.when(F.col("sources").isNull(), 0).otherwise(F.col("n_tokens")).cast("long").alias("n_tokens"))
    docs = docs.where((F.col("n_tokens") > 0) & (F.size("pattern") > 0)).withColumn("at", F.xxhash64("doc_id", F.lit(seed)))
    docs = stored(docs.withColumn("bucket", F.pmod("at", F.lit(BUCKETS)).cast("int")))
    totals = stored(docs.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("n")))
    # one row a set of sources: the nodes of the flow
    patterns = {tuple(r.pattern): r.n for r in sorted(totals.groupBy("pattern").agg(F.sum("n").alias("n")).collect())}
    _, flows = route(patterns, {s: w for s, (w, _) in rows.items()}, {s: c for s, (_, c) in rows.items()}, total)
    # one row a pattern and bucket: where each bucket begins on its pattern's line
    line = Window.partitionBy("pattern")
    before = line.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("pattern", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(line).alias("around"))
    stretches, begun = [], defaultdict(int)
    for (p, s), f in sorted(flows.items()):
        stretches.append((list(p), s, begun[p], begun[p] + f))
        begun[p] += f
    parts = sized.sparkSession.createDataFrame(stretches, "pattern array<string>, source string, first long, last long")
    w = Window.partitionBy("pattern", "bucket").orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.join(starts, ["pattern", "bucket"]).withColumn("middle", F.col("offset") + F.coalesce(F.sum("n_tokens").over(w), F.lit(0)) + F.col("n_tokens") / 2)
    # round k of the line has the record's middle at middle + k * around: count the rounds that fall into the stretch
    rounds = lambda end: F.greatest(F.lit(0), F.ceil((F.col(end) - F.col("middle")) / F.col("around"))).cast("int")
    used = placed.join(parts, "pattern").withColumn("times", rounds("last") - rounds("first"))
    return used.where("times > 0").select("doc_id", "source", "times", "n_tokens")


def shares(mixture: DataFrame, weights: DataFrame) -> DataFrame:
    """source, target_share, n_docs, n_tokens, actual_share, most_used of every source, also of those not reached."""
    by = mixture.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.col("times") * F.col("n_tokens")).alias("n_tokens"), F.max("times").alias("most_used"))
    out = weights.select("source", "target_share").join(by, "source", "left").fillna(0, ["n_docs", "n_tokens", "most_used"])
    return out.withColumn("actual_share", F.coalesce(F.col("n_tokens") / F.sum("n_tokens").over(Window.partitionBy()), F.lit(0.0))).select("source", "target_share", "n_docs", "n_tokens", "actual_share", "most_used")
