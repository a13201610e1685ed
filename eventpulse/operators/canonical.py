"""The canonical event and its message form."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.functions import at_rest, event_time, key_present
from eventpulse.operators.parse import parse_once
from eventpulse.schemas import CANONICAL_TEXT

CANONICAL_FIELDS = CANONICAL_TEXT.fieldNames()
TEXT_PAYLOAD = r'"payload"\s*:\s*"'
LOG_POSITION = ["kafka_partition", "kafka_offset", "kafka_timestamp"]


def _unless_absent(field: str, default: Column) -> Column:
    """The field, its default where the key is absent; an explicit null stays null."""
    value = F.col(field)
    return F.when(value.isNotNull(), value).when(key_present("json", field), None).otherwise(default)


def _payload() -> Column:
    """The payload as JSON. The typed parse gives a text without its quotes, so ``"5"`` would
    become a number; a record that may hold one is read again, as a variant."""
    text = F.col("payload")
    value = F.variant_get(F.try_parse_json("json"), "$.payload", "variant")
    # a variant has no repeated keys, so a record with some is read as text there
    quoted = F.to_json(F.array(text))
    quoted = F.when(text.startswith("{") | text.startswith("["), text).otherwise(
        F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    )
    again = F.coalesce(F.to_json(value), quoted)
    return F.when(text.isNotNull() & F.col("json").rlike(TEXT_PAYLOAD), again).otherwise(text)


def canonicalise(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Canonical events from a ``json`` text column; ``keep`` carries other columns along.

    ``payload`` is JSON text, whatever its type; ``org`` shrinks to its id; null and the empty object both mean no org.
    """
    parsed = parse_once(df, CANONICAL_TEXT)
    org = F.when(
        F.col("org").startswith("{") & (F.col("org") != "{}"),
        F.struct(F.get_json_object("org", "$.id").try_cast("bigint").alias("id")),
    )
    return parsed.select(
        *(keep or []),
        "id",
        "type",
        "actor",
        "repo",
        "created_at",
        F.coalesce(_payload(), _unless_absent("payload", F.lit("{}"))).alias("payload"),
        _unless_absent("public", F.lit(True)).alias("public"),
        org.alias("org"),
    )


def event_rows(canonical: DataFrame) -> DataFrame:
    """Flat rows with what the fact table leaves out: repository url and payload.

    They feed build_repos() and normalised_events(); ``canonical`` keeps the
    message position.
    """
    return at_rest(
        canonical.select(
            F.col("id").alias("event_id"),
            F.col("type").alias("event_type"),
            event_time("created_at").alias("event_created_at"),
            F.col("actor.id").alias("actor_id"),
            F.col("actor.login").alias("actor_login"),
            F.col("repo.id").alias("repo_id"),
            F.col("repo.name").alias("repo_name"),
            F.col("repo.url").alias("repo_url"),
            "payload",
            *LOG_POSITION,
        )
    )


def to_log(canonical: DataFrame) -> DataFrame:
    """K4: key (event id) and value (JSON with nulls written) as bytes.

    The payload is JSON already and goes in as it is, repeated keys included.
    """
    at = CANONICAL_FIELDS.index("payload")
    before, after = [
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
        for names in (CANONICAL_FIELDS[:at], CANONICAL_FIELDS[at + 1 :])
    ]
    opened, closed = F.substring(before, F.lit(1), F.length(before) - 1), F.substring(after, F.lit(2), F.length(after))
    value = F.concat(opened, F.lit(',"payload":'), F.coalesce("payload", F.lit("null")), F.lit(","), closed)
    return canonical.select(F.col("id").cast("binary").alias("key"), value.cast("binary").alias("value"))
