from eventpulse.functions.names import repo_owner, repo_short_name
from eventpulse.functions.records import REQUIRED_FIELDS, json_text, key_present, record_status
from eventpulse.functions.times import at_rest, event_date, event_time, minute_start

__all__ = [
    "REQUIRED_FIELDS",
    "at_rest",
    "event_date",
    "event_time",
    "json_text",
    "key_present",
    "minute_start",
    "record_status",
    "repo_owner",
    "repo_short_name",
]
