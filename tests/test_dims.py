"""Dimensions, normalised events, joins and constraint checks."""

import json
from datetime import datetime, timedelta

from eventpulse.operators import dims, quality
from eventpulse.schemas import ACTORS, EVENTS, REPOS

T0 = datetime(2024, 1, 1)
SCHEMA = """event_id string, event_type string, event_created_at timestamp_ntz, actor_id long, actor_login string,
  repo_id long, repo_name string, repo_url string, kafka_offset long, payload string"""


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def events(spark):
    return spark.createDataFrame(
        [
            ("1", "a", at(0), 1, "ann", 7, "o/old", "u7", 0, '{"b":1,"a":[2]}'),
            ("2", "a", at(5), 1, None, 7, "o/new", None, 3, "bad"),
            ("3", "a", at(5), 1, "anna", 7, "o/tie", None, 2, None),
            ("4", "a", at(9), 2, "bob", 7, None, None, 4, "{}"),
            ("5", "a", at(1), None, "ghost", None, "o/none", None, 5, "null"),
        ],
        SCHEMA,
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_newest_known_value_wins(spark):
    repos = dims.build_repos(events(spark))
    assert [f.simpleString() for f in repos.schema] == [f.simpleString() for f in REPOS]
    assert rows(repos) == [(7, "o/new", "u7", None, None, at(9))]
    actors = dims.build_actors(events(spark))
    assert actors.columns == ACTORS.fieldNames()
    assert rows(actors) == [(1, "anna", None), (2, "bob", None)]


def test_side_table(spark):
    side = spark.createDataFrame([(7, "go", 5), (8, "c", 1)], "repo_id long, language string, stars int")
    assert rows(dims.build_repos(events(spark), side)) == [(7, "o/new", "u7", "go", 5, at(9))]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "u1", "go", 3, at(2)), (2, "b", None, None, None, at(0))], REPOS)
    new = spark.createDataFrame([(1, "a2", None, None, None, at(1)), (3, None, None, None, None, at(3))], REPOS)
    # the new batch is late for 1: its name is the older one
    expected = [(1, "a", "u1", "go", 3, at(2)), (2, "b", None, None, None, at(0)), (3, None, None, None, None, at(3))]
    assert rows(dims.upsert_dim(old, new, "repo_id")) == expected
    assert rows(dims.upsert_dim(dims.upsert_dim(old, new, "repo_id"), new, "repo_id")) == expected
    later = spark.createDataFrame([(1, "a3", None, None, None, at(4))], REPOS)
    assert rows(dims.upsert_dim(old, later, "repo_id"))[0] == (1, "a3", "u1", "go", 3, at(4))


def test_normalised_events(spark):
    found = dims.normalised_events(events(spark))
    assert found.columns == EVENTS.fieldNames()
    payloads = {r.event_id: r.p for r in found.selectExpr("event_id", "to_json(payload) AS p").collect()}
    assert json.loads(payloads["1"]) == {"a": [2], "b": 1}
    assert (payloads["2"], payloads["3"], payloads["4"], payloads["5"]) == (None, None, "{}", "null")
    again = dims.normalised_events(found.withColumnRenamed("created_at", "event_created_at"))
    assert again.count() == 5


def test_orphans_skip_null_keys(spark):
    dim = spark.createDataFrame([(1,)], "actor_id long")
    assert [r.event_id for r in quality.orphans(events(spark), dim, "actor_id").collect()] == ["4"]
    assert rows(quality.orphan_counts(events(spark), dim, "actor_id")) == [(2, 1)]


def test_star_keeps_every_event(spark):
    df = dims.normalised_events(events(spark))
    repos = dims.build_repos(events(spark)).where("repo_id = 0")
    joined = dims.star(df, repos, dims.build_actors(events(spark)))
    assert joined.count() == 5
    found = {r.event_id: (r.repo_name, r.login) for r in joined.collect()}
    assert found["1"] == (None, "anna") and found["5"] == (None, None)


def test_pk_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(quality.pk_violations(df, "k")) == sorted([("a", 2), (None, 1)], key=repr)


def test_null_violations(spark):
    assert tuple(quality.null_violations(events(spark), ["actor_id", "repo_name", "event_id"]).first()) == (1, 1, 0)
    assert tuple(quality.null_violations(events(spark)).first()) == (0, 0, 0)
