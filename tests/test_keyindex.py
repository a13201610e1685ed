"""D3, K6: stored keys in bucketed runs with sketches, against sets."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventpulse.functions.sketches import bitmap_words, holds_all, key_places
from eventpulse.operators import dedup
from eventpulse.session import work_dir
from eventpulse.sinks.keyindex import KeyIndex, Run, covering


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


def name(rng):
    return f"{rng.getrandbits(64):016x}"


def unfinish(index, run):
    os.rename(f"{index.path}/head/{run}/_SUCCESS", f"{index.path}/head/{run}/_unfinished")


def test_a_sketch_holds_its_keys_and_few_others(spark):
    n = 32768 // 16
    own = spark.range(n).select(F.col("id").cast("string").alias("k"))
    bits = own.select(F.explode(key_places("k")).alias("p")).agg(F.bitmap_construct_agg("p").alias("bits"))
    words = bits.select(bitmap_words("bits").alias("words"))
    both = spark.range(20 * n).select(F.col("id").cast("string").alias("k"), (F.col("id") < n).alias("own"))
    found = both.join(words).groupBy("own").agg(F.count_if(holds_all("words", "k")).alias("n"), F.count("*").alias("all"))
    rows = {r.own: (r.n, r.all) for r in found.collect()}
    assert rows[True] == (n, n)
    assert rows[False][0] < 0.005 * rows[False][1]


def test_a_batch_opens_only_the_files_its_sketches_allow(spark):
    rng = random.Random(1)
    index = KeyIndex(spark, work_dir(spark, "opened"), file_keys=200)
    stored = [[name(rng) for _ in range(3000)] for _ in range(3)]
    for batch_id, values in enumerate(stored):
        index.write(keys(spark, values), batch_id)
    files = index.read().inputFiles()
    assert len(files) == 45
    batch = keys(spark, [*stored[0][:2], stored[2][7], *(name(rng) for _ in range(20))])
    allowed = index.files(batch)
    near = index.near(batch)
    opened = set(near.inputFiles())
    assert len(opened) == sum(map(len, allowed.values())) <= 6
    assert all(any(f"/{run.name}/bucket={b}/" in path for run, bs in allowed.items() for b in bs) for path in opened)
    # every file that holds one of the batch's keys is among them
    holding = index._read("ids", index.runs(), index._ids).where(F.col("event_id").isin(stored[0][:2] + [stored[2][7]]))
    assert {r[0] for r in holding.select(F.col("_metadata.file_path")).collect()} <= {p.replace("file:///", "file:/") for p in opened} | opened
    fresh = dedup.drop_seen(batch, near)
    assert fresh.count() == 20
    assert index.near(batch.limit(0)).count() == 0 and index.near(keys(spark, [None])).count() == 0
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_random_batches_repeats_and_merges(spark):
    rng = random.Random(2)
    index = KeyIndex(spark, work_dir(spark, "random"), file_keys=64, fan=2)
    pool, seen = [name(rng) for _ in range(400)], set()
    for batch_id in range(9):
        values = rng.sample(pool, 60) + [None]
        for _ in range(rng.choice([1, 2])):
            known = index.near(keys(spark, values), upto=batch_id - 1)
            fresh = {r.event_id for r in dedup.drop_seen(keys(spark, values), known).collect()} - {None}
            assert fresh == set(values) - seen - {None}
            index.write(keys(spark, fresh), batch_id)
        seen |= fresh
        index.compact()
        assert {r.event_id for r in index.read().collect()} == seen and index.read().count() == len(seen)
    # two runs of a size at most, besides the newest batch
    assert index.runs()[-1] == Run(8, 8) and len(index.runs()) <= 5
    index.expire()
    assert {r.event_id for r in index.read().collect()} == seen
    with pytest.raises(ValueError, match="merged"):
        index.write(keys(spark, ["x"]), 0)


def test_unfinished_runs_do_not_count(spark):
    index = KeyIndex(spark, work_dir(spark, "unfinished"), fan=2)
    for batch_id, value in enumerate("abcd"):
        index.write(keys(spark, [value]), batch_id)
    assert index.compact() == [Run(0, 1)]
    unfinish(index, "run=0-1")
    assert index.runs() == [Run(k, k) for k in range(4)]
    assert sorted(r.event_id for r in index.read(upto=2).collect()) == ["a", "b", "c"]
    assert index.compact() == [Run(0, 1)] and index.runs() == [Run(0, 1), Run(2, 2), Run(3, 3)]
    unfinish(index, "run=3-3")
    assert sorted(r.event_id for r in index.read().collect()) == ["a", "b", "c"]
    assert index.read(upto=-1).count() == 0
    with pytest.raises(ValueError, match="no longer"):
        remove_members(index)
        index.read(upto=0)


def remove_members(index):
    for k in (0, 1):
        unfinish(index, f"run={k}-{k}")


def test_covering():
    runs = [Run(0, 0), Run(1, 1), Run(0, 3), Run(2, 2), Run(4, 4), Run(4, 5), Run(6, 6)]
    assert covering(runs) == [Run(0, 3), Run(4, 5), Run(6, 6)]
    assert [Run(0, n - 1).level(8) for n in (1, 7, 8, 63, 64)] == [0, 0, 1, 1, 2]


def test_an_empty_batch(spark):
    index = KeyIndex(spark, work_dir(spark, "empty"))
    assert index.read().count() == 0 and index.runs() == []
    index.write(keys(spark, []), 0)
    assert index.runs() == [Run(0, 0)] and index.read().count() == 0
    assert index.near(keys(spark, ["a"])).count() == 0


def test_files_of_a_large_run_stay_few():
    from eventpulse.sinks.keyindex import FILE_KEYS, SMALL_FILES, bucket_count

    assert [bucket_count(n, 4096) for n in (0, 4096, 4097, 40_000_000)] == [1, 1, 2, SMALL_FILES]
    assert bucket_count(10**10, 4096) == bucket_count(10**10, FILE_KEYS) == -(-(10**10) // FILE_KEYS)
