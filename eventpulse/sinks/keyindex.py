"""D3, K6: the stored keys in hash-bucketed runs with a Bloom sketch for each file.

A *run* holds the keys of some consecutive batches: ``ids/run=F-L/bucket=B/`` has one
file a bucket, sorted by key, and ``sketch/run=F-L/`` the sketches of every file. A run
has as many buckets as keep a file at FILE_KEYS keys, so files stay alike however
large a run gets; smaller files are made up to SMALL_FILES in a run. ``head/run=F-L/`` is written last and makes a run count; a repeated
batch overwrites its run.

A batch looks its keys up in the sketches, which take SKETCH_KEY_BITS a key, whatever
order the keys have. It then opens only the files for which a sketch lets a key
through, and decides by the keys themselves.

FAN neighbouring runs of one size class are merged, so the number of runs grows with
the logarithm of the number of batches, and each key is rewritten as often.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.functions.sketches import (
    SKETCH_BITS,
    bitmap_words,
    holds_all,
    key_bucket,
    key_places,
    key_segment,
)
from eventpulse.sinks.files import committed, named, remove

FILE_KEYS = 1 << 20
#: Files of fewer keys than FILE_KEYS, as ``file_keys`` may ask for, are made up to this number in a run only.
SMALL_FILES = 128
SKETCH_KEY_BITS = 16
FAN = 8


def bucket_count(keys: int, file_keys: int) -> int:
    """Buckets of ``file_keys`` keys, in a large run of more, so that their number grows with FILE_KEYS alone."""
    return max(1, min(-(-keys // file_keys), SMALL_FILES), -(-keys // max(file_keys, FILE_KEYS)))


class Run(NamedTuple):
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"run={self.first}-{self.last}"

    def level(self, fan: int) -> int:
        """Size class: a run of fan**level batches or more."""
        size, level = self.last - self.first + 1, 0
        while size >= fan ** (level + 1):
            level += 1
        return level


def covering(runs: list[Run]) -> list[Run]:
    """The largest runs that hold each batch once."""
    chosen: list[Run] = []
    for run in sorted(runs, key=lambda r: (r.first, -r.last)):
        if not chosen or run.first > chosen[-1].last:
            chosen.append(run)
    return chosen


class KeyIndex:
    """Keys by the batch that stored them, with lookups that open few files."""

    def __init__(self, spark: SparkSession, path: str, key: str = "event_id", file_keys: int = FILE_KEYS, fan: int = FAN):
        self.spark, self.path, self.key, self.file_keys, self.fan = spark, path, key, file_keys, fan
        self._ids = T.StructType([T.StructField(key, T.StringType())])
        self._sketch = T.StructType(
            [
                T.StructField("bucket", T.IntegerType()),
                T.StructField("segment", T.IntegerType()),
                T.StructField("words", T.ArrayType(T.LongType())),
            ]
        )
        self._head = T.StructType([T.StructField("buckets", T.IntegerType()), T.StructField("segments", T.IntegerType())])

    def _read(self, part: str, runs: list[Run], schema: T.StructType, *more: T.StructField) -> DataFrame:
        """Rows of a part of these runs, with ``run`` and what else the directories tell."""
        fields = [*schema.fields, T.StructField("run", T.StringType()), *more]
        paths = [f"{self.path}/{part}/{run.name}" for run in runs]
        reader = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/{part}")
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], T.StructType(fields))

    def _finished(self) -> list[Run]:
        names = [name.removeprefix("run=") for name in named(self.spark, f"{self.path}/head", "run=")]
        runs = [Run(*map(int, name.split("-"))) for name in names]
        return [run for run in runs if committed(self.spark, f"{self.path}/head/{run.name}")]

    def runs(self, upto: int | None = None) -> list[Run]:
        """The runs that hold all batches, or those up to ``upto``."""
        finished = self._finished()
        chosen = covering([run for run in finished if upto is None or run.last <= upto])
        if upto is not None and any(run.first <= upto < run.last for run in finished) and (not chosen or chosen[-1].last < upto):
            raise ValueError(f"batches up to {upto} are no longer kept apart from later ones")
        return chosen

    def read(self, upto: int | None = None) -> DataFrame:
        """The stored keys, of all batches or up to one."""
        return self._read("ids", self.runs(upto), self._ids, T.StructField("bucket", T.IntegerType())).select(self.key)

    def write(self, df: DataFrame, batch_id: int) -> None:
        """K6: replace what the batch stored before, if anything."""
        if any(run.first <= batch_id <= run.last and run != (batch_id, batch_id) for run in self._finished()):
            raise ValueError(f"batch {batch_id} is part of a merged run")
        self._write(df.select(self.key).where(F.col(self.key).isNotNull()), Run(batch_id, batch_id))

    def _write(self, keys: DataFrame, run: Run) -> None:
        remove(self.spark, f"{self.path}/head/{run.name}")
        n = keys.count()
        buckets = bucket_count(n, self.file_keys)
        segments = max(1, -(-n * SKETCH_KEY_BITS // (buckets * SKETCH_BITS)))
        placed = keys.withColumn("bucket", key_bucket(self.key, buckets))
        gathered = placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", self.key)
        folder = f"{self.path}/ids/{run.name}"
        gathered.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        stored = self._read("ids", [run], self._ids, T.StructField("bucket", T.IntegerType()))
        bits = stored.select("bucket", key_segment(self.key, segments).alias("segment"), F.explode(key_places(self.key)).alias("place"))
        maps = bits.groupBy("bucket", "segment").agg(F.bitmap_construct_agg("place").alias("bits"))
        sketch = maps.select("bucket", "segment", bitmap_words("bits").alias("words"))
        sketch.write.mode("overwrite").parquet(f"{self.path}/sketch/{run.name}")
        head = self.spark.createDataFrame([(buckets, segments)], self._head).coalesce(1)
        head.write.mode("overwrite").parquet(f"{self.path}/head/{run.name}")

    def files(self, batch: DataFrame, upto: int | None = None) -> dict[Run, list[int]]:
        """The buckets of each run that may hold a key of ``batch``, by their sketches.

        The result has at most one entry for each stored file. Sketches are joined
        with the batch's keys; Spark sends the smaller side.
        """
        runs = self.runs(upto)
        if not runs:
            return {}
        heads = {row.run: row for row in self._read("head", runs, self._head).collect()}
        shapes = [F.struct(F.lit(name).alias("run"), F.lit(h.buckets).alias("buckets"), F.lit(h.segments).alias("segments")) for name, h in heads.items()]
        keys = batch.select(F.col(self.key).alias("key")).where("key is not null").distinct()
        probes = keys.select("key", F.explode(F.array(*shapes)).alias("shape")).select(
            "key",
            F.col("shape.run").alias("run"),
            key_bucket("key", F.col("shape.buckets")).alias("bucket"),
            key_segment("key", F.col("shape.segments")).alias("segment"),
        )
        sketches = self._read("sketch", runs, self._sketch)
        hits = probes.join(sketches, ["run", "bucket", "segment"]).where(holds_all("words", "key"))
        found: dict[Run, list[int]] = {}
        for run, bucket in hits.select("run", "bucket").distinct().collect():
            found.setdefault(Run(*map(int, run.split("-"))), []).append(bucket)
        return found

    def near(self, batch: DataFrame, upto: int | None = None) -> DataFrame:
        """The stored keys in the files that may hold a key of ``batch``: all that it can meet, and some more."""
        paths = [
            f"{self.path}/ids/{run.name}/bucket={bucket}"
            for run, buckets in sorted(self.files(batch, upto).items())
            for bucket in sorted(buckets)
        ]
        return self.spark.read.schema(self._ids).parquet(*paths) if paths else self.spark.createDataFrame([], self._ids)

    def compact(self) -> list[Run]:
        """Merge FAN neighbouring runs of a size class while there are as many; returns the new runs.

        The newest batch is left out, because its writer may still repeat it.
        """
        merged = []
        while True:
            live, fan = self.runs()[:-1], self.fan
            groups = (live[i : i + fan] for i in range(len(live) - fan + 1))
            group = next((g for g in groups if len({run.level(fan) for run in g}) == 1), None)
            if group is None:
                return merged
            run = Run(group[0].first, group[-1].last)
            ids = self._read("ids", group, self._ids, T.StructField("bucket", T.IntegerType()))
            self._write(ids.select(self.key), run)
            merged.append(run)

    def expire(self) -> None:
        """Delete runs that a merged one holds, except the newest merged one's: readers
        that began before it may still hold them."""
        finished = self._finished()
        live = covering(finished)
        newest = max((run for run in live if run.last > run.first), default=None, key=lambda run: run.last)
        for run in finished:
            holder = next((r for r in live if r.first <= run.first and run.last <= r.last and r != run), None)
            if holder is not None and holder != newest:
                for part in ("head", "sketch", "ids"):
                    remove(self.spark, f"{self.path}/{part}/{run.name}")
