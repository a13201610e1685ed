"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to.
A pattern can give its words up to REPEATS times; copy r costs r - 1, so the costs
are convex and nothing is repeated while unused words are left. A min-cost flow
routes the patterns' words to the sources' quotas. Each pattern's flow is then drawn
from its documents in an order seeded by a hash of the doc_id: whole rounds first,
then documents in order, the last one with its first words only.

The driver holds one row per pattern, never documents. The order is found by sums
over ORDER_BUCKETS ranges of the hash and running sums within a range, so a source
with a third of all rows is spread over that many groups.

Null texts have no words. A null or absent source is a source of its own, last in
order. Rows with equal doc_id are separate documents; a null doc_id is hashed as
such. With no words at all, all targets are 0.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.llm.tables import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2
SEED = 17
ORDER_BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_order(sources: Iterable[str | None]) -> list[str | None]:
    return sorted(set(sources), key=lambda s: (s is None, s or ""))


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> dict[str | None, float]:
    """``share`` of all sizes dealt out by weight, at most ``repeats`` times its size to each source."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(in_order(sizes))}
    left, open_, target = share * sum(sizes.values()), set(sizes), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] > repeats * sizes[s]}
        if not full:
            return target | {s: each * weight[s] for s in open_}
        for s in full:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def route(capacity: dict[tuple, int], quota: dict[str | None, int], repeats: int = REPEATS) -> dict[tuple, int]:
    """Words that each pattern gives. Patterns that share no source are solved apart."""
    parent: dict = {s: s for s in quota}

    def root(s: str | None) -> str | None:
        while parent[s] != s:
            parent[s] = s = parent[parent[s]]
        return s

    for pattern in capacity:
        for s in pattern[1:]:
            parent[root(s)] = root(pattern[0])
    groups: dict = {}
    for pattern in capacity:
        if pattern:
            groups.setdefault(root(pattern[0]), []).append(pattern)
    flow: dict[tuple, int] = {pattern: 0 for pattern in capacity}
    for patterns in groups.values():
        flow |= _min_cost({p: capacity[p] for p in patterns}, quota, repeats)
    return flow


def _min_cost(capacity: dict[tuple, int], quota: dict[str | None, int], repeats: int) -> dict[tuple, int]:
    """Successive shortest paths on source -> patterns -> sources -> sink."""
    patterns, sources = list(capacity), in_order(s for p in capacity for s in p)
    number = {s: 2 + len(patterns) + k for k, s in enumerate(sources)}
    head, room, cost, edges = [], [], [], [[] for _ in range(2 + len(patterns) + len(sources))]

    def arc(u: int, v: int, most: int, price: int) -> None:
        for a, b, r, c in ((u, v, most, price), (v, u, 0, -price)):
            edges[a].append(len(head))
            head.append(b), room.append(r), cost.append(c)

    for k, p in enumerate(patterns):
        for r in range(repeats):
            arc(0, 2 + k, capacity[p], r)
        for s in p:
            arc(2 + k, number[s], repeats * capacity[p], 0)
    for s in sources:
        arc(number[s], 1, quota[s], 0)
    while True:
        far, via, queue, queued = [float("inf")] * len(edges), [-1] * len(edges), deque([0]), {0}
        far[0] = 0
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for e in edges[u]:
                if room[e] and far[u] + cost[e] < far[head[e]]:
                    far[head[e]], via[head[e]] = far[u] + cost[e], e
                    if head[e] not in queued:
                        queue.append(head[e])
                        queued.add(head[e])
        if via[1] < 0:
            break
        path, v = [], 1
        while v:
            path.append(via[v])
            v = head[via[v] ^ 1]
        most = min(room[e] for e in path)
        for e in path:
            room[e] -= most
            room[e ^ 1] += most
    return {p: sum(room[e ^ 1] for e in edges[0] if head[e] == 2 + k) for k, p in enumerate(patterns)}


def mix(docs: DataFrame, sources: Column, size: Column, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """doc_id, pattern, size, source_size, target, taken for each row of ``docs``.

    ``sources`` is an array column with the sources of a document; source_size and
    target are those of its first source in order. ``size`` counts its words.
    """
    spark = docs.sparkSession
    pattern = F.array_distinct(F.array_sort(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    spot = F.xxhash64(F.lit(seed), F.col("doc_id"))
    rows = docs.select("doc_id", pattern.alias("pattern"), size.alias("size"), spot.alias("spot"))
    rows = stored(rows.withColumn("bucket", F.pmod("spot", F.lit(ORDER_BUCKETS))).withColumn("key", F.to_json("pattern")), "sizes")
    sums = rows.groupBy("key").agg(F.sum("size").alias("size"), F.first("pattern").alias("pattern")).collect()
    capacity = {tuple(row.pattern): row.size for row in sums}
    sizes: dict[str | None, int] = {}
    for own, n in capacity.items():
        for s in own:
            sizes[s] = sizes.get(s, 0) + n
    target = targets(sizes, weights, share, repeats)
    quota = {s: min(round(t), repeats * sizes[s]) for s, t in target.items()}
    flow = route(capacity, quota, repeats)
    plan = []
    for row in sums:
        own = tuple(row.pattern)
        lead = in_order(own)[0]
        whole, rest = divmod(flow[own], row.size) if row.size else (0, 0)
        plan.append((row.key, sizes[lead], float(target[lead]), whole, rest))
    plan = spark.createDataFrame(plan, "key string, source_size long, target double, whole long, rest long")
    ranges = rows.groupBy("key", "bucket").agg(F.sum("size").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("key", "bucket", before.alias("before"))
    within = Window.partitionBy("key", "bucket").orderBy("spot", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(ranges, ["key", "bucket"]).join(plan, "key")
    drawn = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before") - F.col("ahead")))
    return rows.select("doc_id", "pattern", "size", "source_size", "target", (F.col("whole") * F.col("size") + drawn).cast("long").alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """``mix`` with each document in its one source and words between white space."""
    return mix(docs, F.array(F.col("source").cast("string")), n_words(F.col("text").cast("string")))
