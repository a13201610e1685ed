"""T-2, T-3, W3: leaderboards from partial counts, of which the cold ones stay unread.

Partial counts of a compaction are kept apart by level: level L holds counts from 2**L
to 2**(L+1) - 1, and a small table of bounds tells the largest count of each level. A
leaderboard reads the highest levels of all compactions first. What it has read of a
key is a lower bound of its total; the largest unread counts of the compactions that
did not show the key are the rest of an upper bound. It is done when the counts of the
k leaders are complete and no other key can reach the last of them. Else it opens the
next level. Results are exact; in the end everything would be read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.operators.rollups import EVENT_COUNT, ROLLUP_KEYS, rollup_totals
from eventpulse.plans.lake import Lake
from eventpulse.sinks.files import committed, numbered

COUNTS = T.StructType([T.StructField("key", T.StringType()), T.StructField(EVENT_COUNT, T.LongType())])
BOUNDS = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("most", T.LongType()), T.StructField("n_keys", T.LongType())])


class LeaderIndex:
    """Counts by unit (a compaction) and level."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, counts: DataFrame, unit: int) -> None:
        """``counts`` (key, event_count), one row per key. The unit counts once its bounds are written."""
        level = (F.length(F.bin(EVENT_COUNT)) - 1).cast("int")
        kept = counts.where(F.col("key").isNotNull() & (F.col(EVENT_COUNT) > 0)).withColumn("level", level)
        kept.repartition("level").write.mode("overwrite").partitionBy("level").parquet(f"{self.path}/counts/unit={unit}")
        # read with the level as a column of the directories
        stored = self.spark.read.schema(T.StructType([*COUNTS.fields, BOUNDS["level"]])).parquet(f"{self.path}/counts/unit={unit}")
        bounds = stored.groupBy("level").agg(F.max(EVENT_COUNT).alias("most"), F.count("*").alias("n_keys"))
        bounds.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/bounds/unit={unit}")

    def units(self) -> list[int]:
        found = numbered(self.spark, f"{self.path}/bounds", "unit")
        return [n for n in found if committed(self.spark, f"{self.path}/bounds/unit={n}")]

    def bounds(self, units: list[int]) -> dict[tuple[int, int], tuple[int, int]]:
        """(largest count, number of keys) of each unit and level; at most 63 levels a unit."""
        if not units:
            return {}
        schema = T.StructType([*BOUNDS.fields, T.StructField("unit", T.IntegerType())])
        paths = [f"{self.path}/bounds/unit={n}" for n in units]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/bounds").parquet(*paths).collect()
        return {(r.unit, r.level): (r.most, r.n_keys) for r in rows}

    def _read(self, levels: set[tuple[int, int]]) -> DataFrame:
        fields = [*COUNTS.fields, T.StructField("unit", T.IntegerType())]
        paths = [f"{self.path}/counts/unit={unit}/level={level}" for unit, level in sorted(levels)]
        if not paths:
            return self.spark.createDataFrame([], T.StructType(fields))
        rows = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/counts").parquet(*paths)
        return rows.select("key", EVENT_COUNT, "unit")

    def search(self, k: int, units: list[int], live: DataFrame) -> tuple[list[tuple[str, int]], set[tuple[int, int]]]:
        """The ``k`` keys with the largest totals (ties: the smaller key), and the levels that were read.

        ``live`` (key, event_count): counts that no unit holds; they are read whole.
        """
        bounds = self.bounds(units)
        opened: set[tuple[int, int]] = set()
        for unit in units:  # enough keys to begin with
            keys = 0
            for level in sorted((x for u, x in bounds if u == unit), reverse=True):
                if keys < k:
                    opened.add((unit, level))
                    keys += bounds[unit, level][1]
        while True:
            closed = bounds.keys() - opened
            rest = {unit: max((bounds[c][0] for c in closed if c[0] == unit), default=0) for unit in units}
            top, done = self._round(k, opened, rest, live, bool(closed))
            if done:
                return top, opened
            # the level of the largest unread count, wherever it occurs
            highest = max(level for _, level in closed)
            opened |= {c for c in closed if c[1] == highest}

    def _round(self, k: int, opened: set, rest: dict[int, int], live: DataFrame, more: bool) -> tuple[list, bool]:
        counts = self._read(opened).unionByName(live.select("key", F.col(EVENT_COUNT), F.lit(None).cast("int").alias("unit")))
        open_rest = reduce(lambda column, item: column.when(F.col("unit") == item[0], F.lit(item[1])), rest.items(), F.when(F.lit(False), F.lit(0)))
        totals = counts.groupBy("key").agg(
            F.sum(EVENT_COUNT).alias("low"), F.sum(F.coalesce(open_rest, F.lit(0))).alias("shown")
        )
        total_rest = sum(rest.values())
        totals = totals.withColumn("high", F.col("low") + total_rest - F.col("shown")).persist()
        try:
            rows = totals.orderBy(F.desc("low"), "key").limit(k).collect()
            top = [(r.key, r.low) for r in rows]
            if not more:
                return top, True
            if len(rows) < k or any(r.high != r.low for r in rows) or total_rest >= rows[-1].low:
                return top, False
            rivals = totals.where((F.col("high") >= rows[-1].low) & (F.col("high") != F.col("low")) & ~F.col("key").isin([r.key for r in rows]))
            return top, not rivals.limit(1).count()
        finally:
            totals.unpersist()


def leader_index(lake: Lake, rollup: str) -> LeaderIndex:
    return LeaderIndex(lake.spark, f"{lake.root}/leaders/{rollup}")


def index_leaders(lake: Lake, rollups: tuple[str, ...] = ("repo_activity", "actor_activity")) -> None:
    """Index the compactions of the partial counts that are not indexed yet; call it after Lake.compact()."""
    for rollup in rollups:
        index = leader_index(lake, rollup)
        for unit in lake.partials.compactions():
            if unit not in index.units():
                counts = rollup_totals(lake.partials.read_compaction(unit), rollup)
                index.add(counts.select(F.col(ROLLUP_KEYS[rollup]).alias("key"), EVENT_COUNT), unit)


def live_leaders(lake: Lake, rollup: str, k: int = 10) -> DataFrame:
    """The ``k`` largest totals as of the last batch, k rows in order."""
    key = ROLLUP_KEYS[rollup]
    index = leader_index(lake, rollup)
    compactions = lake.partials.compactions()
    units = [unit for unit in compactions if unit in index.units()]
    parts = [lake.partials.read_compaction(unit) for unit in compactions if unit not in units]
    parts.append(lake.partials.read_after(compactions[-1] if compactions else -1))
    live = rollup_totals(reduce(DataFrame.unionByName, parts), rollup)
    live = live.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), EVENT_COUNT)
    top, _ = index.search(k, units, live)
    rows = lake.spark.createDataFrame(top, COUNTS).withColumnRenamed("key", key)
    return rows.orderBy(F.desc(EVENT_COUNT), key)
