"""K4: the keyed log sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Delivery settings of the log's writer.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.compression.type": "gzip",
    "kafka.max.in.flight.requests.per.connection": "1",
}


def writer_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic} | DELIVERY | options


def write_log(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish key and value; equal keys go to the same topic partition."""
    messages.write.format("kafka").options(**writer_options(servers, topic, **options)).save()
