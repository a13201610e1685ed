"""The key check kept up by batch, against a count of all keys."""

import random
from collections import Counter

from eventpulse.operators.quality import pk_violations
from eventpulse.session import work_dir
from eventpulse.sinks.keyaudit import NULLS, KeyAudit


def rows(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, other int")


def test_batches_with_repeats(spark):
    rng = random.Random(3)
    audit = KeyAudit(spark, work_dir(spark, "audit"), "k", buckets=16)
    stored = []
    for batch_id in range(4):
        values = [rng.choice([None, *(f"k{rng.randrange(400)}" for _ in range(6))]) for _ in range(40)] + ["hot"] * 5 * (batch_id == 2)
        for _ in range(rng.choice([1, 2])):
            audit.write(rows(spark, values), batch_id)
        stored += values
        count = Counter(v for v in stored if v is not None)
        want = {k: n for k, n in count.items() if n > 1}
        assert {r.key: r.row_count for r in audit.repeated().collect()} == want
        found = audit.summary("t").first()
        assert tuple(found) == ("t", len(want), stored.count(None))
        audit.compact()
    whole = rows(spark, stored)
    assert pk_violations(whole, "k").where("k is not null").count() == len(want)
    assert audit.drifted(whole).count() == 0
    audit.expire()
    assert tuple(audit.summary("t").first()) == ("t", len(want), stored.count(None))


def test_only_buckets_that_disagree_are_read_again(spark):
    audit = KeyAudit(spark, work_dir(spark, "audit-few"), "k", buckets=32)
    audit.write(rows(spark, [f"k{i}" for i in range(500)]), 0)
    assert audit.suspects() == [] and audit.repeated().count() == 0
    audit.write(rows(spark, ["new", "k17", "k17", None]), 1)
    [bucket] = audit.suspects()
    found = audit.repeated()
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :]
    assert f" = {bucket})" in filters[: filters.index("]")]
    assert [tuple(r) for r in found.collect()] == [("k17", 3)]
    assert audit.suspects(upto=0) == []


def test_a_table_that_lost_or_gained_rows(spark):
    audit = KeyAudit(spark, work_dir(spark, "audit-drift"), "k", buckets=8)
    values = [f"k{i}" for i in range(100)] + [None]
    audit.write(rows(spark, values), 0)
    assert audit.drifted(rows(spark, values)).count() == 0
    assert audit.drifted(rows(spark, values[1:])).count() == 1
    # as many rows in each bucket, but another key
    other = next(f"x{i}" for i in range(100) if same_bucket(spark, audit, f"x{i}", "k0"))
    assert audit.drifted(rows(spark, [other, *values[1:]])).count() == 1
    assert [r.bucket for r in audit.drifted(rows(spark, [*values, None])).collect()] == [NULLS]


def same_bucket(spark, audit, a, b):
    found = audit._keys(rows(spark, [a, b])).select("bucket").distinct().count()
    return found == 1


def test_empty(spark):
    audit = KeyAudit(spark, work_dir(spark, "audit-empty"), "k")
    assert tuple(audit.summary("t").first()) == ("t", 0, 0)
    audit.write(rows(spark, []), 0)
    assert tuple(audit.summary("t").first()) == ("t", 0, 0)
