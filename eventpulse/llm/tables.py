"""Helpers on tables: working copies in the shared folder, parts by id, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.session import work_dir

#: Rows per Arrow batch; a batch of usual texts is about a MB.
BATCH_ROWS = 250
#: Bytes of an Arrow batch, for long texts; a row may be longer.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of this session small, so that a worker holds few texts at a time.

    It holds for the session's later queries, too, since results are computed after the call.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set(BATCH_BYTES, "4m")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read again, so that a
    lost executor costs only its unfinished tasks and lineage ends here."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Empty a stored table that no later step reads, so that its files go."""
    path = df.inputFiles()[:1]
    if path:
        df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path[0].rpartition("/")[0])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_column(docs: DataFrame, name: str = "text") -> int:
    """Place of the text among the columns; it must be a string."""
    at = [column.lower() for column in docs.columns].index(name)
    if docs.schema[at].dataType.typeName() != "string":
        raise TypeError(f"{name} must be a string")
    return at


#: Bits of the largest sieve: 16 MB, whatever the input.
SIEVE_BITS = 1 << 27


def fresh(name: str, columns: list[str]) -> str:
    """A column name that is not taken, whatever the case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _spot(key: Column) -> tuple[Column, Column]:
    """Bucket, from 1, and bit of a key. Bucket 0 holds 0 and below, so places are counted from 1."""
    place = F.shiftrightunsigned(F.xxhash64(key.cast("long")), 64 - (SIEVE_BITS - 1).bit_length()) + 1
    return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)


def _as_long(rows: DataFrame, key: str) -> Column:
    """The key as a long: names in bytes or text by a hash."""
    return F.xxhash64(key) if rows.schema[key].dataType.typeName() in ("binary", "string") else F.col(key).cast("long")


def sieve_of(ids: DataFrame, key: str) -> DataFrame:
    """Bitmap of hashed ids: a bit that is not set proves that the id is absent.

    At most 4097 rows (bucket, words) of 4 KB, whatever the input, so it may be broadcast.
    """
    bucket, bit = _spot(_as_long(ids, key))
    bits = ids.where(F.col(key).isNotNull()).select(bucket.alias("bucket"), bit.alias("bit"))
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    word = "cast(conv(hex(substring(bits, 8 * i + 1, 8)), 16, -10) as bigint)"
    return stored(maps.select("bucket", F.expr(f"transform(sequence(0, 511), i -> {word})").alias("words")), "sieve")


def with_bit(rows: DataFrame, sieve: DataFrame, key: Column, name: str) -> DataFrame:
    """``rows`` and a boolean: whether the bit of ``key`` is set. A null key has no bit."""
    bucket, bit = _spot(key)
    at, words = fresh("sieve_bucket", rows.columns), fresh("sieve_words", rows.columns)
    maps = F.broadcast(sieve.select(F.col("bucket").alias(at), F.col("words").alias(words)))
    # the eight bytes of a word stand with the first one highest
    place = 56 - 8 * F.floor(bit % 64 / 8) + bit % 8
    found = F.getbit(F.get(words, F.floor(bit / 64).cast("int")), place.cast("int")) == 1
    joined = rows.join(maps, key.isNotNull() & (bucket == F.col(at)), "left")
    return joined.select(*[rows[column] for column in rows.columns], F.coalesce(found, F.lit(False)).alias(name))


def _sieved(rows: DataFrame, sieve: DataFrame, key: str, inside: bool) -> DataFrame:
    """The rows whose bit is set, or is not set."""
    name = fresh("in_sieve", rows.columns)
    own = F.when(F.col(key).isNotNull(), _as_long(rows, key))
    return with_bit(rows, sieve, own, name).where(F.col(name) == inside).drop(name)


def only(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose ``key`` is in ``ids`` (one column of that name).

    A bitmap of hashed ids drops most other rows before the shuffle. Its size is
    bounded: with more ids it lets more rows through, and the join decides.
    """
    near = _sieved(rows, sieve_of(ids, key), key, True)
    return near.join(ids.distinct(), key, "left_semi")


def parted(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those that may hold an id of ``ids``, and those that surely hold none.

    The bitmap is that of only(); the second part needs no join, hence no shuffle.
    """
    sieve = sieve_of(ids, key)
    return _sieved(rows, sieve, key, True), _sieved(rows, sieve, key, False)


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo; null counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % modulus


def _fingerprint(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge: the smallest node reachable.

    Alternating large-star and small-star rounds: each links a node's neighbours
    to its smallest neighbour. Both are aggregates and joins on the node: a hub is
    combined before the shuffle, and the aggregate is stored before the join, so that
    Spark can split the hub there. Rounds grow
    with the logarithm of the longest path. Null ends are ignored; no edges, no rows.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stored(pair.where("u > v").distinct(), "edges")
    mark = _fingerprint(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = stored(low, "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "edges")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now = stored(small.where("u > v").distinct(), "edges")
        before, mark = mark, _fingerprint(now)
        if before == mark:
            break
    hubs = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(hubs)


