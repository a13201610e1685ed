"""Activity events derived from the driver's ``events`` table: facts, redeliveries and raw messages.

Every function keeps all rows of the table. The matching SQL is in plans/oracles.py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventpulse.schemas import ENVELOPE

# Stated, so that reading a table of many files needs no job to infer it.
SOURCE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

NOT_NULL_JSON = {"ignoreNullFields": "false"}


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SOURCE).parquet(f"{sf_dir}/events.parquet")


def source_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream; the glob makes a single file acceptable as well."""
    return spark.readStream.schema(SOURCE).parquet(f"{sf_dir}/events.parque[t]")


def _repo_name(k: Column) -> Column:
    numbered = F.concat(F.lit("org"), k % 7, F.lit("/repo"), k)
    return (
        F.when(k % 10 == 0, None)
        .when(k % 10 == 1, F.concat(F.lit("solo"), k))
        .when(k % 10 == 2, F.concat(numbered, F.lit("/x")))
        .otherwise(numbered)
    )


def with_repo(events: DataFrame) -> DataFrame:
    """repo_id and repo_name from ``props``, read once per row (see parse_once)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    parsed = events.select("*", F.inline(F.array(F.struct(k.alias("repo_id")))))
    return parsed.withColumn("repo_name", _repo_name(F.col("repo_id")))


def fact(events: DataFrame, repo: bool = True) -> DataFrame:
    """FACT; without ``repo`` the JSON column of the table is not read at all."""
    return (with_repo(events) if repo else events).select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("ts").alias("event_created_at"),
        F.col("user_id").alias("actor_id"),
        F.concat(F.lit("user"), F.col("user_id")).alias("actor_login"),
        *(["repo_id", "repo_name"] if repo else []),
        F.lit(0).alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").alias("kafka_timestamp"),
    )


def redelivered(facts: DataFrame) -> DataFrame:
    """RED: every tenth event arrives once more, in another partition; ``n`` is its number."""
    n = F.col("kafka_offset")
    places = F.when(n % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return facts.withColumn("n", n).withColumn("kafka_partition", F.explode(places))


def shuffled(messages: DataFrame) -> DataFrame:
    """RED with ids in no order, dealt to five batches; a copy may come before its original."""
    batch = F.when(F.col("kafka_partition") == 0, F.col("n") % 4).otherwise(F.floor(F.col("n") / 10) % 5)
    return messages.withColumns({"event_id": F.md5(F.col("event_id").cast("binary")), "batch": batch.cast("int")})


def bursts(facts: DataFrame) -> DataFrame:
    """Every tenth event arrives three times, up to two hours apart; the partition numbers its arrivals."""
    n = F.col("kafka_offset")
    second = n % 7 * 10
    minutes = F.when(n % 10 == 0, F.array(F.lit(0), second, second + F.floor(n / 10) % 5 * 15)).otherwise(F.array(F.lit(0)))
    late = F.col("kafka_timestamp") + F.make_dt_interval(mins=F.col("minutes").cast("int"))
    arrived = facts.select("*", F.posexplode(minutes).alias("arrival", "minutes"))
    return arrived.select(
        "event_id", F.col("arrival").alias("kafka_partition"), "kafka_offset", late.cast("timestamp").alias("kafka_timestamp")
    )


def _iso(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_messages(numbered: DataFrame) -> DataFrame:
    """RAW: JSON messages over RED, some of them broken by the event's number."""
    n = F.col("n")
    actor = F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login"))
    repo = F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name"))
    created = F.when(n % 83 == 0, "bad").otherwise(_iso("event_created_at"))
    fields = {
        "id": F.col("event_id"),
        "type": F.col("event_type"),
        "actor": actor,
        "repo": repo,
        "created_at": created,
    }

    def text(*names: str) -> Column:
        return F.to_json(F.struct(*[fields[x].alias(x) for x in names]), NOT_NULL_JSON)

    json = (
        F.when(n % 97 == 0, "not json")
        .when(n % 89 == 0, text("id", "type", "repo", "created_at"))
        .otherwise(text(*fields))
    )
    return numbered.select(json.alias("json"), "kafka_partition", "kafka_offset", "kafka_timestamp", "n")


def envelopes(messages: DataFrame) -> DataFrame:
    """ENVELOPE rows of raw messages, as a log source delivers them."""
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("json").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").cast("timestamp").alias("timestamp"),
    ).select(ENVELOPE.fieldNames())


def loose_messages(facts: DataFrame) -> DataFrame:
    """Messages whose optional fields are absent, null, empty or set, with some wrong leaf types."""
    n, k = F.col("kafka_offset"), F.col("repo_id")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def member(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f'"{name}":'), F.lit(value) if isinstance(value, str) else value)

    event_id = F.when(n % 2 == 0, F.col("event_id")).otherwise(quoted(F.col("event_id")))
    actor_id = F.when(n % 79 == 0, '"x"').otherwise(F.col("actor_id").cast("string"))
    repo_id = F.when(n % 73 == 0, '"x"').otherwise(k.cast("string"))
    repo_name = F.coalesce(quoted(F.col("repo_name")), F.lit("null"))
    members = [
        member("id", event_id),
        member("type", quoted(F.col("event_type"))),
        F.concat(F.lit('"actor":{"id":'), actor_id, F.lit(',"login":'), quoted(F.col("actor_login")), F.lit("}")),
        F.concat(
            F.lit('"repo":{"id":'), repo_id, F.lit(',"name":'), repo_name,
            F.lit(',"url":"https://example.org/'), k, F.lit('"}'),
        ),
        member("created_at", quoted(_iso("event_created_at"))),
        F.when(n % 3 == 1, member("public", "null")).when(n % 3 == 2, member("public", "false")),
        F.when(n % 4 == 1, member("payload", "null"))
        .when(n % 4 == 2, member("payload", F.concat(F.lit('{"k": '), k, F.lit("}"))))
        .when(n % 4 == 3, member("payload", quoted(k))),
        F.when(n % 5 == 1, member("org", "null"))
        .when(n % 5 == 2, member("org", "{}"))
        .when(n % 5 == 3, member("org", F.concat(F.lit('{"login":"acme","id":'), k, F.lit("}"))))
        .when(n % 5 == 4, member("org", '{"login":"acme"}')),
    ]
    json = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return facts.select(json.alias("json"), "kafka_partition", "kafka_offset", "kafka_timestamp")


def landed_responses(messages: DataFrame, page: int = 100) -> DataFrame:
    """One JSON array per page of log positions, as an API returns them.

    A page holds the JSON messages of ``page`` positions whatever the size of the
    table. Every tenth page is cut off before its end.
    """
    items = F.array_sort(F.collect_list(F.struct("kafka_offset", "json")))
    end = F.when(F.col("page") % 10 == 7, "").otherwise("]")
    return (
        messages.where(F.col("json") != "not json")
        .groupBy("kafka_partition", F.floor(F.col("kafka_offset") / page).alias("page"))
        .agg(items.alias("items"))
        .select("page", F.concat(F.lit("["), F.concat_ws(",", "items.json"), end).alias("value"))
    )


def landed_array(messages: DataFrame) -> DataFrame:
    """Lines of one JSON array of all messages, by position in the log; broken messages are elements, too."""
    place = F.struct("kafka_partition", "kafka_offset")
    least = messages.agg(F.min(place).alias("least"))
    begin = F.when(place == F.col("least"), "[").otherwise(",")
    lines = messages.join(least).select("kafka_partition", "kafka_offset", F.concat(begin, F.col("json")).alias("value"))
    end = least.select(F.lit(2**31 - 1).alias("kafka_partition"), F.lit(0).cast("long").alias("kafka_offset"), F.lit("]").alias("value"))
    ordered = lines.unionByName(end).repartition(1).sortWithinPartitions("kafka_partition", "kafka_offset")
    return ordered.select("value")
