"""MinHash near-dedup: bottom-k sketches, inverted lists, union estimate, exact check.

One hash function ranks the five-word shingles of a text; the sketch is the K
smallest. Texts with the same shingle set form a class, and classes are compared:

1. Two sets with Jaccard similarity of 0.75 share a least number of sketch values
   (``needed``), but for a chance below 10**-10; of sets of at most K shingles, which
   are their own sketches, the bound is exact. So it is enough to list each sketch
   under its rarest ``size - needed + 1`` values: passages that many texts hold come
   last. At the first value that a pair shares, its places in both orders bound the
   overlap, which drops most pairs that share a frequent passage only. A sketch is a
   sample without replacement, so bounds are tighter the more of a set it holds.
2. Every list links its members to the most typical one, which has the value at
   the earliest place. Pairs are estimated on the union sketch, then verified on
   full sets. That joins groups of copies by about one pair a member.
3. Lists that still hold several components give the pairs across components.
   Pairs inside a component can't change the result and are never formed.

Null or empty texts have an empty set and link with nothing. Rows with a null
doc_id are returned with a null component and kept. Repeated rows are one
document; a repeated doc_id with other texts links whatever any of them links.
Classes are named by 128 bits of a digest: among 3 * 10**10 documents the chance that
any two classes share a name is below 10**-17. Lists, pairs and links hold the number
of a class instead (``node``), which takes a third of the room when shuffled or stored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.llm.tables import components, discard, fresh, only, parted, small_batches, stored, text_column
from eventpulse.llm.words import SPACED, slices, windows, words_of

K = 192
SHINGLE = 5
#: Size of the table of value frequencies that orders the lists (8 MB): fixed, whatever the corpus.
BUCKETS = 1 << 21
#: Standard deviations that an overlap of sketches and an estimated similarity may be off.
SHARED_OFF, ESTIMATE_OFF = 7, 6


def estimate_bound(na: int, nb: int) -> float:
    """The least estimate of linked sets: their union has at most 4/7 of both sizes, of which K are drawn."""
    union = 4 * (na + nb) / 7
    return 0.75 - ESTIMATE_OFF * (0.75 * 0.25 / K * (union - K) / (union - 1)) ** 0.5 if union > K else 0.75


def needed(n: int) -> int:
    """The least number of sketch values that a set of ``n`` shares with any linked set.

    The largest linked set, 4/3 of ``n``, shares the fewest: K values drawn from it
    hold 3/4 of K of the smaller set. Among whole sketches 3/4 of ``n`` are shared.
    """
    whole, high = -(-3 * n // 4), 4 * n / 3
    if high <= K:
        return whole
    cut = math.floor(0.75 * K - SHARED_OFF * (0.75 * 0.25 * K * (high - K) / (high - 1)) ** 0.5)
    return min(whole, cut)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(column, SPACED, lower=True)
    for lo, hi in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        own = words.hashes[lo:hi]
        yield np.unique(windows(own, SHINGLE if len(own) >= SHINGLE else max(1, len(own))))


def _name(own: np.ndarray) -> bytes | None:
    """The class of a set: 128 bits of its digest; null for the empty set."""
    return blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        count, cls, sketch = [], [], []
        for own in shingle_sets(batch.column(1)):
            count.append(len(own))
            cls.append(_name(own))
            sketch.append(own[:K].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(count, pa.int64()), pa.array(cls, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))],
            ["doc_id", "n", "cls", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [own.view(np.int64) for own in shingle_sets(batch.column(1))]
        cls = [_name(own) for own in sets]
        yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "items"])


def _frequencies(classes: DataFrame):
    """Broadcast counts of sketch values by bucket."""
    values = classes.select(F.explode("sketch").alias("value"))
    buckets = values.groupBy(F.col("value").bitwiseAND(BUCKETS - 1).cast("int").alias("bucket"))
    counts = buckets.agg(F.count("*").alias("n")).toArrow()
    weight = np.zeros(BUCKETS, np.float32)
    weight[counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return classes.sparkSession.sparkContext.broadcast(weight)


def _lists(classes: DataFrame) -> DataFrame:
    """(value, node, n, place): each sketch under its rarest values, stored."""
    weights = _frequencies(classes)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        for batch in batches:
            values, sizes, places = [], [], []
            for n, sketch in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = sketch.values.to_numpy()
                order = np.lexsort((own, weight[own & (BUCKETS - 1)]))[: len(own) - needed(n) + 1]
                values.append(own[order])
                sizes.append(np.full(len(order), n, np.int64))
                places.append(np.arange(len(order), dtype=np.int32))
            if values:
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in values])))
                value, size, place = (pa.array(np.concatenate(x)) for x in (values, sizes, places))
                yield pa.RecordBatch.from_arrays([value, ids, size, place], ["value", "node", "n", "place"])

    lists = stored(classes.select("node", "n", "sketch").mapInArrow(rarest, "value long, node long, n long, place int"), "entries")
    weights.destroy()
    return lists


def _possible(a: str, b: str):
    """Whether list entries a and b, if this is their first shared value, can still be linked.

    Sizes must be within 3:4, and linked sets share 3/7 of the sum of their sizes. Of
    the values from this one on, all may be shared. Whole sets need that number; of
    sketches cut at K the larger set's density gives the expected number, and seven
    standard deviations less are needed, those of K draws without replacement.
    """
    na, nb, low, high = F.col(f"{a}.n"), F.col(f"{b}.n"), F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    rest = F.least(F.least(na, F.lit(K)) - F.col(f"{a}.place"), F.least(nb, F.lit(K)) - F.col(f"{b}.place"))
    mean = 3 * K * (1 + low / high) / 7
    spread = F.sqrt(mean * (1 - mean / K) * (high - K) / F.greatest(high - 1, F.lit(1)))
    cut = rest >= F.floor(mean - SHARED_OFF * spread)
    return (4 * low >= 3 * high) & F.when(high <= K, 7 * rest >= 3 * (na + nb)).otherwise(cut)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose estimated similarity may reach the bound."""
    for batch in batches:
        keep = []
        sizes = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
        for a, b, (na, nb) in zip(batch.column(2), batch.column(3), sizes, strict=True):
            a, b = a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64)
            both = np.concatenate((a, b))
            both.sort()
            same = both[1:][both[1:] == both[:-1]]
            union = np.unique(both)[:K]
            keep.append(bool(len(union)) and np.searchsorted(same, union[-1], side="right") >= estimate_bound(na, nb) * len(union))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""
    ends = stored(_ends(pairs), "ends")
    own = stored(only(classes.select("node", "sketch", "n"), ends, "node"), "own")
    left = own.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("n").alias("na"))
    right = own.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("n").alias("nb"))
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "na", "nb")
    near = stored(near.mapInArrow(_estimated, "a long, b long"), "near")
    discard(own)
    reps = classes.select("node", "cls", F.col("rep").alias("doc_id"))
    ids = stored(_ends(near).join(reps, "node"), "ids")
    sets = only(texts, ids.select("doc_id")).mapInArrow(_sets, "cls binary, items array<long>")
    sets = stored(sets.dropDuplicates(["cls"]).join(ids.select("cls", "node"), "cls").select("node", "items"), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("ia"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("ib"))
    shared = F.size(F.array_intersect("ia", "ib"))
    joined = near.join(left, "a").join(right, "b").withColumn("shared", shared)
    linked = joined.where("100 * shared >= 75 * (size(ia) + size(ib) - shared)").select("a", "b")
    linked = stored(linked, "linked")
    discard(sets)
    return linked


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    signs, label = _labelled(docs, by_id=True)
    label = label.select(F.col("cls").alias("_cls"), F.col("first.rep").alias("component_id"))
    joined = signs.join(label, signs.cls == label["_cls"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _labelled(docs: DataFrame, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls) of each row, and (cls, rep, first) of each class: its smallest doc_id, and
    that of its component with the class it comes from. ``by_id``: a doc_id links the classes of its texts."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    full = stored(rows.mapInArrow(_sketches, "doc_id long, n long, cls binary, sketch array<long>"), "sketches")
    signs = stored(full.select("doc_id", "n", "cls"), "signs")
    named = signs.where("doc_id is not null and cls is not null")
    reps = stored(named.groupBy("cls").agg(F.min("doc_id").alias("rep")), "reps")
    classes = full.join(reps, (full.cls == reps.cls) & (full.doc_id == reps.rep)).select(full.cls, "n", "sketch", "rep")
    # numbers hold from here on, since the rows are stored with them
    classes = stored(classes.dropDuplicates(["cls"]).withColumn("node", F.monotonically_increasing_id()), "classes")
    discard(full)
    names = stored(classes.select("cls", "rep", "node"), "names")
    edges = _links(classes, rows)
    discard(classes)
    if by_id:
        ends = named.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a < b").select("doc_id", "a")
        same = stored(named.join(stored(ends, "ids"), "doc_id").select("a", F.col("cls").alias("b")), "same")
        for end in ("a", "b"):
            same = same.join(names.select(F.col("cls").alias(end), F.col("node").alias(f"node_{end}")), end).drop(end)
        edges = edges.unionByName(same.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    found = components(edges, "a", "b")
    part = names.join(found, "node", "left").select("cls", "rep", F.coalesce("component", "node").alias("part"))
    part = stored(part, "parts")
    first = stored(part.groupBy("part").agg(F.min(F.struct("rep", "cls")).alias("first")), "firsts")
    return signs, part.join(first, "part").select("cls", "rep", "first")


def _links(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between classes that connect all that the similarity connects."""
    lists = _lists(classes)
    # stored before they are joined, so that Spark can split a hot value
    many = stored(lists.groupBy("value").count().where("count > 1").select("value"), "many")
    entries, lists = lists, stored(lists.join(many, "value", "left_semi"), "lists")
    discard(entries)
    head = stored(lists.groupBy("value").agg(F.min(F.struct("place", "n", "node")).alias("h")), "heads")
    star = lists.join(head, "value").select(F.struct("place", "n", "node").alias("x"), "h").where("h.node != x.node")
    star = star.where(_possible("h", "x"))
    pairs = star.select(F.least("h.node", "x.node").alias("a"), F.greatest("h.node", "x.node").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    found = stored(components(_verified(pairs, classes, texts), "a", "b"), "parts")
    entry = F.struct("place", "n", "node").alias("x")
    label = lists.join(found, "node", "left").select("value", entry, F.coalesce("component", "node").alias("part"))
    label = stored(label, "labelled")
    discard(lists)
    mixed = label.groupBy("value").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("value")
    mixed = stored(label.join(mixed, "value"), "mixed")
    discard(label)
    # a pair is met at its first shared value only: entries carry the values listed before them
    seen = Window.partitionBy("x.node").orderBy("x.place").rowsBetween(Window.unboundedPreceding, -1)
    mixed = mixed.withColumn("earlier", F.collect_list("value").over(seen))
    one = mixed.select("value", F.col("x").alias("a"), F.col("part").alias("pa"), F.col("earlier").alias("ea"))
    two = mixed.select("value", F.col("x").alias("b"), F.col("part").alias("pb"), F.col("earlier").alias("eb"))
    apart = (F.col("a.node") < F.col("b.node")) & (F.col("pa") != F.col("pb"))
    across = one.join(two, (one.value == two.value) & apart & _possible("a", "b") & ~F.arrays_overlap("ea", "eb"))
    across = across.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    across = stored(across.join(pairs, ["a", "b"], "left_anti"), "across")
    known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return known.unionByName(_verified(across, classes, texts))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicate texts, all columns as they were: that with the smallest doc_id.

    Texts are judged, not ids: rows that share a doc_id stay if their texts belong to
    different groups. Of rows with one doc_id and shingle set (the empty set, too) one
    stays, a null text only if there is no other. Only rows that may be dropped or
    repeated are joined; the texts of all others are not shuffled.
    """
    signs, label = _labelled(docs, by_id=False)
    keeper = label.select("cls", F.col("first.rep").alias("rep"), (F.col("first.cls") == F.col("cls")).alias("leads"))
    counts = signs.where("doc_id is not null").groupBy("doc_id", "cls").agg(F.count("*").alias("rows"))
    stays = F.coalesce(F.col("leads") & (F.col("doc_id") == F.col("rep")), F.lit(True))
    marked = counts.join(keeper, "cls", "left").select("doc_id", "cls", "rows", stays.alias("stays"))
    marked = stored(marked.where("not stays or rows > 1"), "marked")
    maybe, sure = parted(docs, marked.select("doc_id"))
    at, width = text_column(docs), len(docs.columns)
    cls, place, lost_id, lost = (fresh(name, docs.columns) for name in ("cls", "place", "lost_id", "lost"))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            names = pa.array([_name(own) for own in shingle_sets(batch.column(at))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], names], [*batch.schema.names, cls])

    named = maybe.mapInArrow(classed, T.StructType([*docs.schema.fields, T.StructField(cls, T.BinaryType())]))
    dropped = marked.where("not stays").select(F.col("doc_id").alias(lost_id), F.col("cls").alias(lost))
    rows = named.join(dropped, (F.col("doc_id").cast("long") == F.col(lost_id)) & (F.col(cls) == F.col(lost)), "left_anti")
    order = Window.partitionBy(F.col("doc_id").cast("long"), cls).orderBy(F.asc_nulls_last("text"))
    first = rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return sure.unionByName(first.select(*docs.columns))
