"""Events whose dimension row arrives later, across batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.sinks.tables import BatchTable

DIM = [T.StructField("dim", T.StringType()), T.StructField("id", T.LongType())]
WAITING = T.StructType([*DIM, T.StructField("event_id", T.StringType()), T.StructField("since", T.LongType())])
SETTLED = T.StructType([*WAITING.fields, T.StructField("settled", T.LongType())])
ENTRY = ["dim", "id", "event_id"]


class PendingOrphans:
    """Foreign keys that are enforced in the end: an orphan waits until its dimension row arrives.

    Three tables by batch: the known ids of each dimension, the references that found
    none (waiting), and those of them that a later batch settled. A batch is compared
    with earlier ones only, so repeating it changes nothing. compact() keeps what is open
    as of a batch, so a batch reads that and the batches since, not what was settled.
    """

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str]):
        """``keys``: the foreign key column of the events for each dimension."""
        self.keys = keys
        self.known = BatchTable(spark, f"{root}/known", T.StructType(DIM), partition_by=["dim"], sort_by=["id"])
        self.waiting = BatchTable(spark, f"{root}/waiting", WAITING, partition_by=["dim"], sort_by=["id"])
        self.still = BatchTable(spark, f"{root}/still", WAITING, partition_by=["dim"], sort_by=["id"])
        self.settled = BatchTable(spark, f"{root}/settled", SETTLED, partition_by=["dim"], sort_by=["id"])

    def write(self, events: DataFrame, dims: dict[str, DataFrame], batch_id: int) -> None:
        """One batch: ``events`` with an ``event_id``, and the dimension rows that came with it."""
        before = batch_id - 1
        rows = [df.select(F.lit(dim).alias("dim"), F.col(self.keys[dim]).cast("long").alias("id")) for dim, df in dims.items()]
        came = reduce(DataFrame.unionAll, rows).where("id is not null").distinct()
        self.known.write(came.join(self.known.read(before), ["dim", "id"], "left_anti"), batch_id)

        # keys are looked up once each; a key that many events miss is one row there
        refs = reduce(DataFrame.unionAll, [
            events.select(F.lit(dim).alias("dim"), F.col(key).cast("long").alias("id"), "event_id") for dim, key in self.keys.items()
        ]).where("id is not null")
        missing = refs.select("dim", "id").distinct().join(self.known.read(batch_id), ["dim", "id"], "left_anti")
        orphans = refs.join(missing, ["dim", "id"], "left_semi").distinct()
        self.waiting.write(orphans.withColumn("since", F.lit(batch_id).cast("long")), batch_id)

        arrived = self.known.read_batch(batch_id)
        found = self.open(before).join(arrived, ["dim", "id"], "left_semi")
        self.settled.write(found.withColumn("settled", F.lit(batch_id).cast("long")), batch_id)

    def open(self, upto: int | None = None) -> DataFrame:
        """(dim, id, event_id, since): references that still wait, of all batches or up to one."""
        kept = [n for n in self.still.batches() if upto is None or n <= upto]
        after = kept[-1] if kept else -1
        batches = self.waiting.batches()
        last = max(batches, default=-1) if upto is None else min(upto, max(batches, default=-1))
        if not set(range(after + 1, last + 1)) <= set(batches):
            raise ValueError(f"batches up to {upto} are no longer kept apart from later ones")
        rows = self.waiting.read_after(after, upto)
        rows = self.still.read_batch(after).unionByName(rows) if kept else rows
        return rows.join(self.settled.read_after(after, upto).select(ENTRY), ENTRY, "left_anti")

    def history(self, upto: int | None = None) -> DataFrame:
        """Every reference that has waited, with the batch that settled it or NULL."""
        still = self.open(upto).withColumn("settled", F.lit(None).cast("long"))
        return self.settled.read(upto).unionByName(still)

    def compact(self) -> int | None:
        """Keep what is open as of the last batch but one; the newest may still be repeated."""
        done = self.settled.batches()[:-1]
        if done and done[-1] not in self.still.batches():
            self.still.write(self.open(done[-1]), done[-1])
            self.known.compact()
        return done[-1] if done else None

    def expire(self) -> None:
        """Delete what the newest state but one has replaced; what was settled stays."""
        kept = self.still.batches()
        if len(kept) > 1:
            self.waiting.forget(kept[-2])
            self.still.forget(kept[-2] - 1)
        self.known.expire()
