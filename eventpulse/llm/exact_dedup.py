"""Exact dedup by progressive refinement: length, then prefix hash, then full hash. DataFrame functions only.

Texts are equal if they agree after lower-casing A-Z alone, which keeps their length in bytes.

1. One pass notes the length of each text and a 64-bit hash of its first HEAD
   characters. Counts by length tell which lengths occur more than once.
2. Among those, counts by length and prefix hash tell which groups still hold
   several rows. A group is named by a 64-bit hash; a clash only lets a text
   through to the next step.
3. Surviving groups become a bitmap of at most 16 MB, which is broadcast. A second
   pass digests (SHA-256) the texts whose bit is set, in place; other contents are
   not looked at. Equal digests are equal texts.

No text is shuffled: steps 1 and 2 move counts, step 3 digests and ids. A hot group
is counted before the shuffle, and its rows meet its one count in a join that Spark
can split.

Null texts count as empty, and empty texts equal each other. The row with the
largest doc_id of a group stays; repeated rows share that doc_id and are all marked
``kept`` (deduplicated() returns one of them). Rows with a null doc_id stay only if
all rows of their group have none. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.llm.tables import fresh, sieve_of, stored, with_bit

#: Characters of a text that the prefix hash covers.
HEAD = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small(text: Column) -> Column:
    """A-Z in lower case, all else unchanged. lower() is the faster form where every character is ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _length() -> Column:
    return F.octet_length(_text())


def _head() -> Column:
    return F.xxhash64(small(F.substring(_text(), 1, HEAD)))


def _group() -> Column:
    return F.xxhash64(_length(), _head())


def survivors(docs: DataFrame) -> DataFrame:
    """(grp): the names of groups with one length and prefix hash that hold more than one row."""
    signs = stored(docs.select(_length().alias("n"), _head().alias("head")), "lengths")
    lengths = stored(signs.groupBy("n").count().where("count > 1").select("n"), "repeated-lengths")
    heads = signs.join(lengths, "n", "left_semi").groupBy("n", "head").count().where("count > 1")
    return stored(heads.select(F.xxhash64("n", "head").alias("grp")), "groups")


def exact_duplicates(docs: DataFrame, all_digests: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs`` (doc_id, text).

    ``text_sha256`` is null for texts that steps 1 and 2 told apart, unless ``all_digests``
    asks for the digest of these, too; it has no part in the result then.
    """
    sieve = sieve_of(survivors(docs), "grp")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    digest = F.sha2(small(_text()), 256)
    marked = with_bit(rows, sieve, _group(), "open").select(
        "doc_id", "open", (digest if all_digests else F.when(F.col("open"), digest)).alias("text_sha256")
    )
    marked = stored(marked, "digests")
    groups = _counted(marked.where("open"), "text_sha256")
    joined = marked.where("open").join(groups, "text_sha256", "left")
    single = marked.where("not open").withColumns({"keep_id": F.lit(None).cast("long"), "group_size": F.lit(None).cast("long")})
    return joined.unionByName(single).select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def _counted(marked: DataFrame, digest: str) -> DataFrame:
    """Rows and largest doc_id of each digest that occurs more than once."""
    counts = marked.groupBy(digest).agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    return stored(counts.where("group_size > 1"), "copies")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text, all columns as they were: that with the largest doc_id.

    Rows that may be copies are digested and joined with the counts by digest; the
    others pass without a shuffle. Of repeated rows any one stays.
    """
    sieve = sieve_of(survivors(docs), "grp")
    is_open, digest = fresh("open", docs.columns), fresh("digest", docs.columns)
    marked = with_bit(docs, sieve, _group(), is_open)
    maybe = marked.where(is_open).withColumn(digest, F.sha2(small(_text()), 256))
    found = maybe.select(F.col(digest).alias("digest"), F.col("doc_id").cast("long").alias("doc_id"))
    groups = _counted(found, "digest").select(F.col("digest").alias("copied"), "keep_id")
    own = maybe.select(F.struct(*docs.columns).alias("row"), F.col(digest).alias("digest"))
    joined = own.join(groups, F.col("digest") == F.col("copied"), "left")
    last = joined.where(F.col("copied").isNull() | F.col("row.doc_id").cast("long").eqNullSafe(F.col("keep_id")))
    one = F.row_number().over(Window.partitionBy("digest").orderBy(F.lit(0)))
    first = last.withColumn("place", one).where("place = 1")
    return marked.where(~F.col(is_open)).select(*docs.columns).unionByName(first.select("row.*"))
