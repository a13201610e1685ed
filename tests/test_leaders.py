"""T-2, T-3, W3: leaders from levels of counts, against all counts added up."""

import random

import pytest

from eventpulse.plans import fixtures
from eventpulse.plans.lake import Lake
from eventpulse.plans.leaders import COUNTS, LeaderIndex, index_leaders, leader_index, live_leaders
from eventpulse.operators.rollups import partial_counts
from eventpulse.session import work_dir


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), COUNTS)


def top(k, *parts):
    total = {}
    for part in parts:
        for key, n in part.items():
            if key is not None:
                total[key] = total.get(key, 0) + n
    return sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:k]


def indexed(spark, parts):
    index = LeaderIndex(spark, work_dir(spark, "leaders"))
    for unit, part in enumerate(parts):
        index.add(frame(spark, part), unit)
    return index


def test_cold_levels_stay_unread(spark):
    rng = random.Random(1)
    parts = []
    for _ in range(3):
        part = {f"hot{k}": 100_000 + rng.randrange(50_000) for k in range(12)}
        part |= {f"warm{k}": rng.randrange(1000, 4000) for k in range(50)} | {f"cold{k}": rng.randrange(1, 30) for k in range(500)}
        parts.append(part)
    index = indexed(spark, parts)
    live = {"hot3": 5, "cold7": 900, "new": 2}
    found, opened = index.search(10, index.units(), frame(spark, live))
    assert found == top(10, *parts, live)
    assert opened and all(level >= 16 for _, level in opened)
    files = index._read(opened).inputFiles()
    assert files and not any(f"level={level}/" in path for path in files for level in range(16))
    # a key that is cold in one unit is only known when that level is read
    parts[1]["hot0"] = 3
    index.add(frame(spark, parts[1]), 1)
    found, opened = index.search(10, index.units(), frame(spark, live))
    assert found == top(10, *parts, live)


@pytest.mark.parametrize("seed", range(8))
def test_random_counts(spark, seed):
    rng = random.Random(seed)
    names = [None, *(f"k{i}" for i in range(30))]
    draw = [lambda: rng.randrange(1, 5), lambda: 2 ** rng.randrange(12), lambda: int(rng.paretovariate(0.5))][seed % 3]
    parts = [{name: draw() for name in rng.sample(names, rng.randrange(31))} for _ in range(4)]
    index = indexed(spark, parts[:3])
    for k in (1, 5, 40):
        found, _ = index.search(k, index.units(), frame(spark, {n: c for n, c in parts[3].items() if n is not None}))
        assert found == top(k, *parts)


def test_compactions_that_are_not_indexed_count(spark):
    lake = Lake(spark, work_dir(spark, "leaders-lake"))
    facts = fixtures.fact(fixtures.source(spark, "/root/testdata/sf0.001"))
    want = [(r[0], r[1]) for r in facts.where("actor_login is not null").groupBy("actor_login").count().orderBy("count", "actor_login", ascending=[False, True]).limit(7).collect()]
    assert live_leaders(lake, "actor_activity").count() == 0
    for batch_id in range(6):
        lake.partials.write(partial_counts(facts.where(f"kafka_offset % 6 = {batch_id}")), batch_id)
        if batch_id in (1, 3, 4):
            lake.partials.compact()
        if batch_id == 3:
            index_leaders(lake)
    assert leader_index(lake, "actor_activity").units() == [0, 2] and lake.partials.compactions() == [0, 2, 3]
    assert [tuple(r) for r in live_leaders(lake, "actor_activity", 7).collect()] == want
    index_leaders(lake)
    assert [tuple(r) for r in live_leaders(lake, "actor_activity", 7).collect()] == want
