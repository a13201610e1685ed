"""Data model: the record shapes and the tables of each layer."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _L, _I, _TS, _NTZ = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampType(),
    T.TimestampNTZType(),
)

# One message of the log, as every log source delivers it.
ENVELOPE = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", _S),
    ("partition", _I),
    ("offset", _L),
    ("timestamp", _TS),
)

# The part of an event's JSON that the fact table keeps.
EVENT = _struct(
    ("id", _S),
    ("type", _S),
    ("created_at", _S),
    ("actor", _struct(("id", _L), ("login", _S))),
    ("repo", _struct(("id", _L), ("name", _S))),
)

# The whole canonical event. ``payload`` and ``org`` stay JSON text here,
# because only the text tells ``{}``, ``null`` and an absent key apart.
CANONICAL_TEXT = _struct(
    ("id", _S),
    ("type", _S),
    ("actor", _struct(("id", _L), ("login", _S), ("url", _S))),
    ("repo", _struct(("id", _L), ("name", _S), ("url", _S))),
    ("created_at", _S),
    ("payload", _S),
    ("public", T.BooleanType()),
    ("org", _S),
)

# Timestamps carry no zone at rest and mean UTC.
FACT = _struct(
    ("event_id", _S),
    ("event_type", _S),
    ("event_created_at", _NTZ),
    ("actor_id", _L),
    ("actor_login", _S),
    ("repo_id", _L),
    ("repo_name", _S),
    ("kafka_partition", _I),
    ("kafka_offset", _L),
    ("kafka_timestamp", _NTZ),
)

QUARANTINE = _struct(
    ("status", _S),
    ("json", _S),
    ("kafka_partition", _I),
    ("kafka_offset", _L),
    ("kafka_timestamp", _NTZ),
)

MINUTE = _struct(("minute", _NTZ), ("event_count", _L))
TYPES = _struct(("event_type", _S), ("event_count", _L), ("last_updated", _NTZ))
REPO_ACTIVITY = _struct(("repo_name", _S), ("event_count", _L), ("last_updated", _NTZ))
ACTOR_ACTIVITY = _struct(("actor_login", _S), ("event_count", _L), ("last_updated", _NTZ))

# Counts of one batch for all rollups; ``minute`` or ``key`` holds the rollup's key.
PARTIALS = _struct(("rollup", _S), ("minute", _NTZ), ("key", _S), ("event_count", _L))

REPOS = _struct(
    ("repo_id", _L),
    ("repo_name", _S),
    ("repo_url", _S),
    ("language", _S),
    ("stars", _I),
    ("last_updated", _NTZ),
)
ACTORS = _struct(("actor_id", _L), ("login", _S), ("actor_type", _S))
EVENTS = _struct(
    ("event_id", _S),
    ("event_type", _S),
    ("repo_id", _L),
    ("actor_id", _L),
    ("created_at", _NTZ),
    ("payload", T.VariantType()),
)

INGEST_METRICS = _struct(
    ("polls", _L),
    ("fetched", _L),
    ("invalid", _L),
    ("errors", _L),
    ("duplicates", _L),
    ("published", _L),
)

FACT_COLUMNS = FACT.fieldNames()
FACT_NOT_NULL = ["event_id", "event_type", "event_created_at"]

PRIMARY_KEYS = {
    "fact": "event_id",
    "minute": "minute",
    "types": "event_type",
    "repo_activity": "repo_name",
    "actor_activity": "actor_login",
    "repos": "repo_id",
    "actors": "actor_id",
    "events": "event_id",
}
