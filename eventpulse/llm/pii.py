"""PII by candidate gradient boosting, with DataFrame functions only.

* Generators propose overlapping spans: four strict kinds with a validity rule
  (email, ip, card, phone) and two loose ones (any long number, anything around an @).
* A strict span that passes its rule is always reported. A loose span that overlaps
  one is a positive example, any other a negative one; the rule itself (checksum,
  range, digit count) is no feature, only format and context are.
* Features are small integers, so all candidates of the corpus reduce to a table of
  feature tuples with counts, at most the product of FEATURES' sizes. Trees of depth
  two are boosted on that table; it is all that the driver gets.
* Documents are parted by a hash of their id: trees are fitted on all but one in
  HELD_PART, and that one calibrates. For each loose kind the threshold is the lowest at
  which PRECISION of its held-out candidates above it are positive. Loose spans above it
  that overlap no strict one are reported too: numbers and addresses that look and stand
  like personal data but fail a rule.

Places are code points. ``split`` gives the text between matches and
``regexp_extract_all`` the matches; running sums of their lengths give the places.
Possessive patterns keep long digit runs from deep recursion; ``\\G`` lets a match
begin right after another one without trying every place in a run.

Null or empty texts have no span. Rows are numbered, so null and repeated doc_ids
each keep their own result. Without positives nothing loose is reported.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.llm.tables import stored

STRICT = 4
#: Name, pattern, and a string without which there is no match.
GENERATORS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", "."),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    ("number", r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,40}+", ""),
    ("address", r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++", "@"),
)
#: Sizes of the features: loose kind, digits, length, separators, sign, bracket, left, right, word before.
FEATURES = (2, 8, 6, 5, 2, 2, 4, 4, 2)
HINT = r"(?i)(?:tel|phone|call|fax|mobile|mail|contact|card|visa|account|ip|addr)[^A-Za-z]{0,4}[a-z]{0,8}[^A-Za-z]{0,4}$"
CONTEXT = 24
TREES = 25
RATE = 0.4
PRECISION = 0.9
HELD_PART = 4


class Split(NamedTuple):
    """Leaf value if feature <= cut, and if not; a leaf is a number or one more split."""

    feature: int
    cut: int
    low: float | Split
    high: float | Split


def _candidates(docs: DataFrame) -> DataFrame:
    """A row per match of each generator, and one without kind for every row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    kinds = []
    for k, (_, pattern, needed) in enumerate(GENERATORS):
        there = F.col("text").rlike(pattern)
        there = F.contains("text", F.lit(needed)) & there if needed else there
        parts = F.struct(
            F.lit(k).alias("k"), F.split("text", pattern, -1).alias("gaps"),
            F.regexp_extract_all("text", F.lit(pattern), 0).alias("found"),
        )
        kinds.append(F.when(there, parts))
    some = F.filter(F.array(*kinds), lambda x: x.isNotNull())
    each = rows.select("row", "doc_id", F.explode_outer(some).alias("x")).select("row", "doc_id", "x.k", "x.gaps", F.posexplode_outer("x.found").alias("i", "found"))
    gap, after = F.get("gaps", F.col("i")), F.get("gaps", F.col("i") + 1)
    return each.select(
        "row", "doc_id", "k", "i", F.length(gap).alias("gap"), F.length("found").alias("size"), "found",
        F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(after, F.lit(1)).alias("after"),
    )


def _passes() -> Column:
    digits = F.regexp_replace("found", "[^0-9]", "")
    count = F.length(digits)
    small = F.forall(
        F.split("found", r"\."),
        lambda part: (F.length(F.regexp_replace(part, "^0+", "")) <= 3) & (F.coalesce(F.right(part, F.lit(3)).try_cast("int"), F.lit(999)) <= 255),
    )
    return (
        F.when(F.col("k") == 0, True).when(F.col("k") == 1, small)
        .when(F.col("k") == 2, count.between(13, 19) & F.call_function("luhn_check", digits)).when(F.col("k") == 3, count.between(9, 15))
        .otherwise(False)
    )


def _side(char: Column) -> Column:
    return F.when(F.coalesce(char, F.lit("")) == "", 0).when(char.rlike(r"\s"), 1).when(char.rlike(r"[\p{L}0-9]"), 2).otherwise(3)


def _features() -> list[Column]:
    digits = F.length(F.regexp_replace("found", "[^0-9]", ""))
    marks = F.length(F.regexp_replace("found", r"[^\x20().-]", ""))
    bins = F.when(digits < 7, 0).when(digits < 9, 1).when(digits < 11, 2).when(digits < 13, 3).when(digits < 16, 4).when(digits == 16, 5).when(digits < 20, 6).otherwise(7)
    return [
        F.col("k") - STRICT, bins, F.least(F.floor(F.col("size") / 6), F.lit(5)).cast("int"), F.least(marks, F.lit(4)),
        F.col("found").startswith("+").cast("int"), F.col("found").contains("(").cast("int"),
        _side(F.right("before", F.lit(1))), _side(F.col("after")), F.coalesce(F.col("before").rlike(HINT), F.lit(False)).cast("int"),
    ]


def _placed(docs: DataFrame) -> DataFrame:
    """Candidates with start, end, whether they pass, and for loose ones whether a strict span overlaps."""
    own = Window.partitionBy("row", "k").orderBy("i")
    until, ahead = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("gap").over(until) + F.coalesce(F.sum("size").over(ahead), F.lit(0))
    rows = _candidates(docs).withColumn("start", start).withColumn("end", F.col("start") + F.col("size")).withColumn("passes", _passes())
    rows = rows.select("row", "doc_id", "k", "start", "end", "passes", *[f.alias(f"f{n}") for n, f in enumerate(_features())])
    line = Window.partitionBy("row").orderBy("start", F.col("passes").desc(), "k")
    before = F.max(F.when(F.col("passes"), F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("passes"), F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    overlaps = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    return rows.withColumn("overlaps", overlaps)


def _leaf(rows: list[tuple]) -> float:
    slope, bend = sum(r[1] for r in rows), sum(r[2] for r in rows)
    return RATE * slope / (bend + 1.0)


def _gain(rows: list[tuple]) -> float:
    slope, bend = sum(r[1] for r in rows), sum(r[2] for r in rows)
    return slope * slope / (bend + 1.0)


def _tree(rows: list[tuple], depth: int) -> float | Split:
    """The best split of (features, slope, bend) rows, or a leaf if none gains."""
    best = (1e-9, None)
    if depth:
        for feature, size in enumerate(FEATURES):
            for cut in range(size - 1):
                low = [r for r in rows if r[0][feature] <= cut]
                high = [r for r in rows if r[0][feature] > cut]
                if low and high and (gain := _gain(low) + _gain(high) - _gain(rows)) > best[0]:
                    best = (gain, (feature, cut, low, high))
    if best[1] is None:
        return _leaf(rows)
    feature, cut, low, high = best[1]
    return Split(feature, cut, _tree(low, depth - 1), _tree(high, depth - 1))


def value_of(tree: float | Split, features: tuple) -> float:
    while isinstance(tree, Split):
        tree = tree.low if features[tree.feature] <= tree.cut else tree.high
    return tree


Table = list[tuple[tuple, int, int]]


def grow(table: Table) -> list[float | Split]:
    """Boosted trees from (features, candidates, positives); none without positives."""
    if not sum(positive for _, _, positive in table):
        return []
    score, trees = [0.0] * len(table), []
    for _ in range(TREES):
        rows = []
        for (features, n, positive), s in zip(table, score, strict=True):
            p = 1 / (1 + math.exp(-s))
            rows.append((features, positive - n * p, n * p * (1 - p)))
        trees.append(tree := _tree(rows, 2))
        score = [s + value_of(tree, features) for s, (features, _, _) in zip(score, table, strict=True)]
    return trees


class Cut(NamedTuple):
    """A threshold, and the share of positives above it and of all positives that are above it."""

    threshold: float
    precision: float
    recall: float


def calibrated(trees: list[float | Split], table: Table) -> Cut:
    """The lowest threshold at which PRECISION of the candidates above are positive; infinite if there is none."""
    best = Cut(math.inf, 0.0, 0.0)
    if not trees:
        return best
    score = [sum(value_of(tree, features) for tree in trees) for features, _, _ in table]
    ordered = sorted(zip(score, table, strict=True), key=lambda x: -x[0])
    n, positive, every = 0, 0, sum(row[2] for row in table)
    for k, (s, (_, own, own_positive)) in enumerate(ordered):
        n, positive = n + own, positive + own_positive
        last = k + 1 == len(ordered) or ordered[k + 1][0] < s
        if last and positive and positive >= PRECISION * n:
            best = Cut(s - 1e-9, positive / n, positive / every)
    return best


def boost(table: Table) -> tuple[list[float | Split], float]:
    """Trees, and the threshold on the table that they were fitted on; (no trees, inf) without positives."""
    trees = grow(table)
    return trees, calibrated(trees, table).threshold


def learn(rows: DataFrame) -> tuple[list[float | Split], list[Cut]]:
    """Trees and the cut of each loose kind, from placed candidates. The driver gets counts by feature tuple."""
    names = [f"f{n}" for n in range(len(FEATURES))]
    loose = rows.where(F.col("k") >= STRICT)
    held = F.pmod(F.xxhash64(F.coalesce("doc_id", "row"), F.lit(11)), F.lit(HELD_PART)) == 0
    counts = loose.groupBy(*names, held.alias("held")).agg(F.count("*").alias("n"), F.sum(F.col("overlaps").cast("long")).alias("positive")).collect()
    parts = [sorted((tuple(r[n] for n in names), r.n, r.positive) for r in counts if r.held == side) for side in (False, True)]
    trees = grow(parts[0])
    return trees, [calibrated(trees, [row for row in parts[1] if row[0][0] == kind]) for kind in range(FEATURES[0])]


def _column(tree: float | Split) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(F.col(f"f{tree.feature}") <= tree.cut, _column(tree.low)).otherwise(_column(tree.high))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, strict and spans (arrays of k, start, end, in that order) for each row of ``docs``.

    ``k`` numbers GENERATORS; ``strict`` holds the spans that pass a rule, ``spans`` all that are reported.
    """
    rows = stored(_placed(docs), "candidates")
    trees, cuts = learn(rows)
    score = sum((_column(tree) for tree in trees), F.lit(0.0))
    chosen = F.col("passes")
    for kind, cut in enumerate(cuts):
        chosen |= (F.col("k") == STRICT + kind) & ~F.col("overlaps") & (score >= F.lit(cut.threshold))
    span = F.struct("k", "start", "end")
    found = rows.groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("passes"), span))).alias("strict"),
        F.array_sort(F.collect_list(F.when(chosen, span))).alias("spans"),
    )
    return found.select("doc_id", "strict", "spans")


def joined(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(name) for name, _, _ in GENERATORS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")
