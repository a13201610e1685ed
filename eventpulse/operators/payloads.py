"""M3, C4: what payloads look like: fields and kinds by event type, drift, typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Counts of one batch. ``field`` is empty for the payload as a whole, else the name of a member of it.
SHAPES = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
#: Column types of the kinds that schema_of_variant() names; others stay variants.
TYPED = {"BIGINT": "bigint", "STRING": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


def _kind(value: str):
    """BIGINT, STRING, OBJECT, ARRAY, VOID and so on: the outermost type."""
    return F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)


def payload_shapes(events: DataFrame, payload: str = "payload") -> DataFrame:
    """Counts by event type, field and kind. ``payload`` is a variant; a NULL one is not counted.

    Members are counted beside the payload itself, so ``n`` of a field against that of
    the payload tells how often it is there. Counts are combined before the shuffle.
    """
    present = events.where(F.col(payload).isNotNull()).select("event_type", F.col(payload).alias("value"))
    whole = present.select("event_type", F.lit("").alias("field"), _kind("value").alias("kind"))
    objects = present.where(_kind("value") == "OBJECT")
    inner = objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("value").outer()).select(F.col("key"), F.col("value").alias("inner")))
    members = inner.select("event_type", F.col("key").alias("field"), _kind("inner").alias("kind"))
    counts = whole.unionAll(members).groupBy("event_type", "field", "kind").agg(F.count("*").alias("n"))
    return counts.select(SHAPES.fieldNames())


def add_shapes(shapes: DataFrame) -> DataFrame:
    """Counts of any number of batches as one."""
    return shapes.groupBy("event_type", "field", "kind").agg(F.sum("n").alias("n")).select(SHAPES.fieldNames())


def payload_schema(shapes: DataFrame) -> DataFrame:
    """(event_type, field, kinds, n, share): the merged schema. ``share`` is how many payloads of the type have the field."""
    fields = shapes.groupBy("event_type", "field").agg(F.sort_array(F.collect_set("kind")).alias("kinds"), F.sum("n").alias("n"))
    whole = fields.where("field = ''").select("event_type", F.col("n").alias("payloads"))
    share = F.col("n") / F.col("payloads")
    return fields.join(whole, "event_type").select("event_type", "field", F.array_join("kinds", ",").alias("kinds"), "n", share.alias("share"))


def payload_drift(before: DataFrame, batch: DataFrame) -> DataFrame:
    """(event_type, field, kind, n, change): what a batch has that no batch before it had.

    ``change``: ``type`` for an event type not met before, ``field`` for a new field of
    a known one, ``kind`` for a new kind of a known field.
    """
    types = before.select("event_type").distinct().withColumn("known_type", F.lit(True))
    fields = before.select("event_type", "field").distinct().withColumn("known_field", F.lit(True))
    new = batch.join(before.select("event_type", "field", "kind"), ["event_type", "field", "kind"], "left_anti")
    named = new.join(types, "event_type", "left").join(fields, ["event_type", "field"], "left")
    change = F.when(F.col("known_type").isNull(), "type").when(F.col("known_field").isNull(), "field").otherwise("kind")
    return named.select(*SHAPES.fieldNames(), change.alias("change"))


def shredded(events: DataFrame, schema: DataFrame, payload: str = "payload") -> DataFrame:
    """Events with a typed column ``payload_<field>`` for each field that has had one kind in all event types.

    ``schema`` is payload_schema(), limited by the caller if payloads have very many
    fields: names and kinds are collected. VOID (a JSON null) counts with any kind. Of
    fields that differ in case only the first is taken; a name with both sorts of quotes
    has no path and stays in the payload.
    """
    kinds = schema.where("field <> ''").select("field", F.explode(F.split("kinds", ",")).alias("kind")).where("kind <> 'VOID'")
    single = kinds.groupBy("field").agg(F.collect_set("kind").alias("all")).where("size(all) = 1")
    columns, taken = {}, {name.lower() for name in events.columns}
    for field, kind in sorted((row.field, row.all[0]) for row in single.collect()):
        name, path = f"payload_{field}", _path(field)
        if kind in TYPED and path and name.lower() not in taken:
            columns[name] = F.try_variant_get(payload, path, TYPED[kind])
            taken.add(name.lower())
    return events.withColumns(columns)


def _path(field: str) -> str | None:
    quote = next((q for q in "\"'" if q not in field), None)
    return quote and f"$[{quote}{field}{quote}]"
