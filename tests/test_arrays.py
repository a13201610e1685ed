"""Arrays split by bracket depth over byte ranges."""

import json
import random

import pytest

from eventpulse.session import work_dir
from eventpulse.sources.arrays import split_arrays
from pyspark.sql import functions as F


def land(spark, path, **files):
    """One file for each name, with exactly this text."""
    sc = spark.sparkContext
    for name, text in files.items():
        place = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}.json")
        out = place.getFileSystem(sc._jsc.hadoopConfiguration()).create(place, True)
        out.write(bytearray(text.encode()))
        out.close()


def elements(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.response.rpartition("/")[2].removesuffix(".json"), []).append(r.json)
    return found


@pytest.fixture(params=[40, 1000, 10**8], ids="{}B".format)
def ranges(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choice('ab,[]{}"\\:é \n\t') for _ in range(rng.randrange(12)))
    if kind < 5:
        return rng.choice([1, -2.5, True, None, 10**12])
    if kind < 7:
        return {value(rng, 9) if rng.random() < 0.3 else f"k{k}": value(rng, depth + 1) for k in range(rng.randrange(4))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(4))]


def test_elements_of_random_arrays(spark, ranges):
    rng = random.Random(ranges)
    path, want = work_dir(spark, "arrays"), {}
    for k in range(6):
        rows = [{str(key): value(rng) for key in range(rng.randrange(3))} if rng.random() < 0.7 else value(rng) for _ in range(rng.choice([0, 1, 30]))]
        texts = [json.dumps(row, ensure_ascii=bool(k % 2), separators=rng.choice([(",", ":"), (", ", " : ")])) for row in rows]
        space = rng.choice(["", " ", "\n", "\r\n\t"])
        land(spark, path, **{f"f{k}": f"{space}[{space}" + f"{space},{space}".join(texts) + f"{space}]{space}"})
        want[f"f{k}"] = sorted(texts)
    got = elements(split_arrays(spark, path))
    assert {name: sorted(rows) for name, rows in got.items()} == {name: rows for name, rows in want.items() if rows}


def test_one_array_is_read_by_several_tasks(spark, ranges):
    path = work_dir(spark, "one-array")
    rows = [{"id": str(k), "type": 'a "},{[', "payload": {"x": ["]", "\\", "\\\""], "n": k}} for k in range(500)]
    text = json.dumps(rows)
    land(spark, path, big=text)
    found = split_arrays(spark, path)
    assert sorted(json.loads(j)["payload"]["n"] for j in elements(found)["big"]) == list(range(500))
    scanned = spark.read.option("lineSep", ",").text(path)
    tasks = scanned.select(F.spark_partition_id()).distinct().count()
    assert tasks >= min(50, len(text) // ranges // 2)


@pytest.mark.parametrize("text", ['[{"a":1},{"b":2}', '[{"a":1}]}', '{"a":[1,2]}', '["open]', "", "nothing", '[1],[2]', '[{"a":"x}]'])
def test_what_is_no_array_is_one_row(spark, text):
    path = work_dir(spark, "broken")
    land(spark, path, bad=text, good="[7, 8]")
    got = elements(split_arrays(spark, path))
    assert sorted(got["good"]) == ["7", "8"]
    if text == "":
        assert "bad" not in got
    elif text == "[1],[2]":
        assert len(got["bad"]) >= 1
    else:
        assert len(got["bad"]) == 1 and text.startswith(got["bad"][0])


def test_empty_elements_are_rows(spark):
    path = work_dir(spark, "holes")
    land(spark, path, holes="[1,,2]", none="[ ]")
    assert {k: sorted(v) for k, v in elements(split_arrays(spark, path)).items()} == {"holes": ["", "1", "2"]}


def test_elements_inside_a_range_are_whole_before_any_shuffle():
    import pyarrow as pa

    from eventpulse.sources import arrays

    def batch(*texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([7] * n), pa.array([0] * n), pa.array(texts), pa.array([0] * n, pa.int32()), pa.array([0] * n)],
            ["file", "block", "text", "start_inside", "start_depth"],
        )

    batches = [batch('[{"a":"x', ']"', '"b":1}', "2"), batch("[3", "4]", r'"\"', '"')]
    rows = [row for out in arrays._pieces(iter(batches)) for row in out.to_pylist()]
    want = [(0, True, b'[{"a":"x,]","b":1}'), (1, False, b"2"), (2, False, b"[3,4]"), (3, True, None)]
    assert [(r["number"], r["edge"], r["json"]) for r in rows[:3]] == want[:3]
    assert rows[-1]["edge"] and rows[-1]["number"] == 3 + (rows[-1]["json"] is None)
    changes = [row for out in arrays._changes(iter(batches)) for row in out.to_pylist()]
    assert [(r["flips"], r["range0"], r["first"], r["last"]) for r in changes] == [(0, 1, b'[{"a":"x', b'"')]
