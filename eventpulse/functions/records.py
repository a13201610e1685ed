"""Expressions over one raw JSON record."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys every event must carry.
REQUIRED_FIELDS = ["id", "type", "actor", "repo", "created_at"]

# A brace followed by something else than a comma, a bracket or the end.
AFTER_BRACE = r"\}\s*[^,\]}\s]"


def json_text(value: str | Column = "value") -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string").alias("json")


def key_present(json: str, key: str) -> Column:
    """True where the JSON object has the key, even with a null value."""
    return F.array_contains(F.json_object_keys(json), key)


def record_status(json: str, time: str = "event_created_at") -> Column:
    """Status of a parsed record whose required fields are columns next to its text.

    A parser stops at the end of an object and does not see what follows it. So the text
    must end with the object's brace; and where a brace is followed by what can't follow
    one outside a string, the text is read once more as an array of one element. The
    keys are looked at only for records with a NULL required field, to tell an absent key
    from a null.
    """
    text = F.col(json)
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    alone = ~text.rlike(AFTER_BRACE) | F.coalesce(one, F.lit(False))
    closed = F.rtrim(text, F.lit(" \t\r\n")).endswith("}") & alone
    keys = F.json_object_keys(json)
    required = F.array(*[F.lit(name) for name in REQUIRED_FIELDS])
    filled = reduce(and_, [F.col(name).isNotNull() for name in REQUIRED_FIELDS])
    return (
        F.when(filled & closed & F.col(time).isNotNull(), "ok")
        .when(filled & closed, "bad_timestamp")
        .when(keys.isNull() | ~closed, "malformed")
        .when(F.size(F.array_except(required, keys)) > 0, "missing_required")
        .otherwise("null_required")
    )
