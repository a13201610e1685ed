"""M3, C4: payload shapes, merged schema, drift and typed columns."""

import json
import random

from pyspark.sql import functions as F

from eventpulse.operators import payloads


def events(spark, *rows):
    df = spark.createDataFrame(list(rows), "event_type string, json string")
    return df.select("event_type", F.parse_json("json").alias("payload"))


def kind(value):
    if value is None:
        return "VOID"
    if isinstance(value, bool):
        return "BOOLEAN"
    return {dict: "OBJECT", list: "ARRAY", str: "STRING", int: "BIGINT"}[type(value)]


def plain(rows):
    out = {}
    for event_type, text in rows:
        if text is None:
            continue
        value = json.loads(text)
        keys = [("", kind(value))] + ([(k, kind(v)) for k, v in value.items()] if isinstance(value, dict) else [])
        for field, name in keys:
            out[event_type, field, name] = out.get((event_type, field, name), 0) + 1
    return out


def shapes(df):
    return {(r.event_type, r.field, r.kind): r.n for r in df.collect()}


def some(seed):
    rng = random.Random(seed)
    values = [None, True, 5, "t", [], [1, "x"], {}]
    rows = []
    for _ in range(60):
        value = rng.choice([*values, *({f"f{rng.randrange(4)}": rng.choice(values) for _ in range(3)} for _ in range(6))])
        rows.append((rng.choice(["a", "b", None]), None if rng.random() < 0.1 else json.dumps(value)))
    return rows


def test_shapes_add_up(spark):
    one, two = some(1), some(2)
    counted = [payloads.payload_shapes(events(spark, *rows)) for rows in (one, two)]
    assert shapes(counted[0]) == plain(one)
    assert shapes(payloads.add_shapes(counted[0].unionAll(counted[1]))) == plain(one + two)
    assert "Python" not in counted[0]._jdf.queryExecution().executedPlan().toString()


def test_drift(spark):
    before = payloads.payload_shapes(events(spark, ("a", '{"k": 1}'), ("a", "null")))
    batch = payloads.payload_shapes(events(spark, ("a", '{"k": 2, "new": "x"}'), ("a", '{"k": "two"}'), ("b", "{}"), ("b", None), ("a", '"t"')))
    got = {(r.event_type, r.field, r.kind, r.n, r.change) for r in payloads.payload_drift(before, batch).collect()}
    assert got == {("a", "new", "STRING", 1, "field"), ("a", "k", "STRING", 1, "kind"), ("b", "", "OBJECT", 1, "type"), ("a", "", "STRING", 1, "kind")}
    assert payloads.payload_drift(batch, batch).count() == 0
    assert payloads.payload_drift(before.limit(0), before).select("change").distinct().collect() == [("type",)]


def test_schema_and_typed_columns(spark):
    rows = [("a", '{"k": 1, "s": "x", "mixed": 1, "we\\"ird": true}'), ("a", '{"k": null, "mixed": "y", "K": 2}'), ("b", '{"k": 7}'), ("b", '"text"'), ("b", "[1]")]
    df = events(spark, *rows)
    schema = payloads.payload_schema(payloads.payload_shapes(df))
    got = {(r.event_type, r.field): (r.kinds, r.n, round(r.share, 3)) for r in schema.collect()}
    assert got["a", ""] == ("OBJECT", 2, 1.0) and got["a", "k"] == ("BIGINT,VOID", 2, 1.0) and got["a", "s"] == ("STRING", 1, 0.5)
    assert got["b", ""] == ("ARRAY,OBJECT,STRING", 3, 1.0) and got["b", "k"] == ("BIGINT", 1, 0.333)
    out = payloads.shredded(df, schema)
    assert out.columns == ["event_type", "payload", "payload_K", "payload_s", 'payload_we"ird']
    typed = dict(out.dtypes)
    assert typed["payload_s"] == "string" and typed['payload_we"ird'] == "boolean" and "payload_mixed" not in typed
    assert sorted(str(r.payload_s) for r in out.collect()) == ["None"] * 4 + ["x"]


def test_batches_read_messages_once(spark):
    from eventpulse.plans import catalog

    files = {f for shapes in catalog._payload_batches(spark, "/root/testdata/sf0.001") for f in shapes.inputFiles()}
    assert files and not any("events.parquet" in f for f in files)
    assert all("sort=" in f for f in files)
