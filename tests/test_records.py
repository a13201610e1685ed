"""Edge rows of parsing, classification, canonicalisation and scalar expressions."""

import json

import pytest
from pyspark.sql import functions as F

from eventpulse.functions import event_time
from eventpulse.operators.canonical import canonicalise, to_log
from eventpulse.operators.enrich import enrich_repo
from eventpulse.operators.parse import classify, flatten, parse_once, type_violations
from eventpulse.schemas import EVENT

GOOD = {
    "id": "1",
    "type": "PushEvent",
    "actor": {"id": 7, "login": "ann"},
    "repo": {"id": 9, "name": "o/r"},
    "created_at": "2024-01-01T00:00:30Z",
}


def event(**changes):
    return json.dumps(GOOD | changes)


def without(key):
    return json.dumps({k: v for k, v in GOOD.items() if k != key})


def messages(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "kafka_offset long, json string")
    return df.select(
        "json", F.lit(0).alias("kafka_partition"), "kafka_offset", F.current_timestamp().alias("kafka_timestamp")
    )


def by_offset(df):
    return {row.kafka_offset: row for row in df.collect()}


STATUS = [
    (event(), "ok"),
    (event(id=5), "ok"),
    (event(actor={}), "ok"),
    (event(actor={"id": "x"}), "ok"),
    (event(extra=[1, 2]), "ok"),
    ("not json", "malformed"),
    ('{"id":"1"', "malformed"),
    (event()[:-1], "malformed"),
    (event() + " trailing", "malformed"),
    (event() + " \n", "ok"),
    (event() + event(), "malformed"),
    (event() + "\n " + event(), "malformed"),
    (event() + " 5}", "malformed"),
    (event(x="}{ } and } { so on"), "ok"),
    (event(x=[{"a": {}}, {"b": "}x"}], y="}"), "ok"),
    ('[{"id":"9"}]', "malformed"),
    ("", "malformed"),
    (None, "malformed"),
    ("{}", "missing_required"),
    (json.dumps({"ID" if k == "id" else k: v for k, v in GOOD.items()}), "missing_required"),
    *[(without(key), "missing_required") for key in GOOD],
    *[(event(**{key: None}), "null_required") for key in GOOD],
    (event(actor="ann"), "null_required"),
    (event(created_at="bad"), "bad_timestamp"),
]


def test_record_status(spark):
    found = by_offset(classify(messages(spark, *[text for text, _ in STATUS])))
    assert [found[i].status for i in range(len(STATUS))] == [status for _, status in STATUS]


def test_parse_leaves(spark):
    texts = ["not json", "{}", '{"id":"1"', None, event(actor={"id": "x", "login": "ann"}), event(id=5)]
    rows = by_offset(parse_once(messages(spark, *texts), EVENT))
    for i in range(4):
        assert (rows[i].id, rows[i].type, rows[i].actor, rows[i].repo, rows[i].created_at) == (None,) * 5
    assert (rows[4].actor.id, rows[4].actor.login, rows[4].id) == (None, "ann", "1")
    assert rows[5].id == "5"


def test_flatten_names_and_keeps_every_row(spark):
    flat = by_offset(flatten(classify(messages(spark, event(), "not json"))))
    row = flat[0]
    assert (row.event_id, row.event_type, row.actor_id, row.actor_login) == ("1", "PushEvent", 7, "ann")
    assert (row.repo_id, row.repo_name) == (9, "o/r")
    assert flat[1].event_id is None


def test_type_violations_name_the_leaf(spark):
    texts = [event(), event(actor={"id": "x"}, repo={"id": "y"}), event(repo={}), event(actor={"id": None})]
    rows = type_violations(classify(messages(spark, *texts))).collect()
    assert sorted((r.kafka_offset, r.leaf) for r in rows) == [(1, "actor.id"), (1, "repo.id")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-01T00:00:30Z", "2024-01-01 00:00:30"),
        ("2024-01-01T05:30:00+05:30", "2024-01-01 00:00:00"),
        ("bad", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(event_time("t").cast("string").alias("t"))
    assert df.first().t == expected


def test_repo_names(spark):
    names = {
        "o/r": ("o", "r"),
        "solo": ("solo", None),
        "a/b/c": ("a", "b"),
        "": ("", None),
        "/x": ("", "x"),
        None: (None, None),
    }
    df = enrich_repo(spark.createDataFrame([(n,) for n in names], "repo_name string"))
    assert {r.repo_name: (r.repo_owner, r.repo_short_name) for r in df.collect()} == names


CANONICAL = [
    ({}, {"payload": {}, "public": True, "org": None}),
    ({"public": None, "payload": None}, {"payload": None, "public": None, "org": None}),
    ({"public": False}, {"public": False}),
    ({"payload": {"b": 1, "a": [1.5, None]}}, {"payload": {"a": [1.5, None], "b": 1}}),
    ({"org": {}}, {"org": None}),
    ({"org": None}, {"org": None}),
    ({"org": {"id": 3, "login": "acme"}}, {"org": {"id": 3}}),
    ({"org": {"login": "acme"}}, {"org": {"id": None}}),
    ({"id": 5}, {"id": "5"}),
    ({"actor": {"id": 1}}, {"actor": {"id": 1, "login": None, "url": None}}),
    ({"repo": {"id": 1, "url": "u", "x": 2}}, {"repo": {"id": 1, "name": None, "url": "u"}}),
    ({"type": 'quo"teé\n'}, {"type": 'quo"teé\n'}),
]


def test_canonical_messages(spark):
    df = messages(spark, *[event(**changes) for changes, _ in CANONICAL])
    rows = to_log(canonicalise(df)).collect()
    assert len(rows) == len(CANONICAL)
    for row, (changes, expected) in zip(rows, CANONICAL):
        value = json.loads(bytes(row.value))
        assert list(value) == ["id", "type", "actor", "repo", "created_at", "payload", "public", "org"]
        assert {k: value[k] for k in expected} == expected
        assert bytes(row.key).decode() == value["id"]


def test_canonical_keeps_long_payloads_whole(spark):
    payload = {"commits": [{"sha": str(i), "message": "m" * 50} for i in range(3000)]}
    row = to_log(canonicalise(messages(spark, event(payload=payload)))).first()
    assert json.loads(bytes(row.value))["payload"] == payload


def test_event_time_needs_date_and_time(spark):
    texts = [("12:30:00",), ("2024-01-01",), ("2024-01-01T00:00:30Z",), ("2024-01-01 00:00:30",), (None,)]
    found = spark.createDataFrame(texts, "t string").select(event_time("t").isNotNull().alias("ok")).collect()
    assert [r.ok for r in found] == [False, False, True, True, False]


PAYLOADS = ['"text"', '"5"', "5", "true", "[1,2]", '{"k":1,"k":2}', '"{\\"a\\":1}"', '"q\\"z"', "null"]


def test_payloads_pass_unchanged(spark):
    """Texts, numbers, arrays, repeated keys: the JSON of the payload is what came in."""
    texts = [event()[:-1] + f', "payload": {payload}}}' for payload in PAYLOADS]
    texts.append(event(x=1)[:-1] + ', "x": 2, "payload": "in a record with repeated keys"}')
    values = [bytes(row.value).decode() for row in to_log(canonicalise(messages(spark, *texts))).collect()]
    wanted = [*PAYLOADS, '"in a record with repeated keys"']
    assert all(f'"payload":{want},"public"' in value for want, value in zip(wanted, values, strict=True))
