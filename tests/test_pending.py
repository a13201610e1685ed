"""References that wait for their dimension row, against a plain version."""

import random

import pytest

from eventpulse.plans.pending import PendingOrphans
from eventpulse.session import work_dir


def plain(batches):
    """{(dim, id, event): (since, settled)}"""
    known, out = set(), {}
    for n, (events, repos, actors) in enumerate(batches):
        known |= {("repos", i) for i in repos if i is not None} | {("actors", i) for i in actors if i is not None}
        for event, repo, actor in events:
            for ref in (("repos", repo), ("actors", actor)):
                if ref[1] is not None and ref not in known:
                    out.setdefault((*ref, event), [n, None])
        for entry, when in out.items():
            if when[1] is None and entry[:2] in known:
                when[1] = n
    return {entry: tuple(when) for entry, when in out.items()}


def write(spark, pending, batch, n):
    events, repos, actors = batch
    rows = spark.createDataFrame(events, "event_id string, repo_id long, actor_id long")
    dims = {
        "repos": spark.createDataFrame([(i,) for i in repos], "repo_id long"),
        "actors": spark.createDataFrame([(i,) for i in actors], "actor_id long"),
    }
    pending.write(rows, dims, n)


def history(pending, upto=None):
    return {(r.dim, r.id, r.event_id): (r.since, r.settled) for r in pending.history(upto).collect()}


def test_orphans_are_settled_when_their_row_arrives(spark):
    rng = random.Random(4)
    batches = []
    for n in range(5):
        events = [(f"e{n}-{k}", rng.choice([None, *range(8)]), rng.choice([0, 0, 0, *range(6)])) for k in range(20)]
        batches.append((events, rng.sample([None, *range(8)], 2), rng.sample(range(6), 1)))
    keys = {"repos": "repo_id", "actors": "actor_id"}
    once, again = (PendingOrphans(spark, work_dir(spark, "pending"), keys) for _ in range(2))
    for n, batch in enumerate(batches):
        write(spark, once, batch, n)
        assert history(once) == plain(batches[: n + 1])
        for _ in range(2):  # every batch is repeated, also after a compaction
            write(spark, again, batch, n)
            again.compact()
    want = plain(batches)
    assert history(again) == want and again.history().count() == len(want)
    still = {entry for entry, (_, settled) in want.items() if settled is None}
    assert {(r.dim, r.id, r.event_id) for r in again.open().collect()} == still
    assert any(settled is not None for _, settled in want.values()) and still
    # a compaction drops what was settled, so that later batches don't read it
    read = [path for path in again.open().inputFiles() if "/waiting/" in path or "/still/" in path]
    assert read and all("batch_id=3/" in path or "batch_id=4/" in path for path in read)
    assert again.still.read_batch(3).count() < once.waiting.read(upto=3).count()
    again.expire()
    assert again.waiting.batches() == [3, 4] and again.still.batches() == [2, 3]
    assert history(again) == want
    write(spark, again, batches[4], 4)
    assert history(again) == want
    with pytest.raises(ValueError, match="no longer"):
        again.open(1).count()


def test_empty_batches(spark):
    pending = PendingOrphans(spark, work_dir(spark, "pending-empty"), {"repos": "repo_id", "actors": "actor_id"})
    write(spark, pending, ([], [], []), 0)
    write(spark, pending, ([("a", 1, None)], [], []), 1)
    write(spark, pending, ([], [1], []), 2)
    assert history(pending) == {("repos", 1, "a"): (1, 2)}
    assert history(pending, 1) == {("repos", 1, "a"): (1, None)}
