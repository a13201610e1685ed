"""Secret scans with multipart credential linking.

Strong kinds stand for themselves: ``assign`` (a named value), ``access`` (a cloud
access id), ``hex`` (a long hexadecimal run). Weak parts prove nothing alone:
``name`` (a user or client name), ``endpoint`` (an address) and ``mixed`` (a run of
mixed characters). Every part has a scope, SCOPE code points to either side. An
interval join over the parts of a text, sorted by place, reports

* a mixed run with an access id, a name or an endpoint in its scope,
* a name or an endpoint with a secret (assign, hex or a mixed run) in its scope.

Weak parts that overlap a strong one are dropped. Spans are in code points, end
exclusive, ordered by start and then by kind as listed in KINDS. Null or empty
texts have no span; each row is judged for itself, so null and repeated ids don't
matter; texts are read whole, a text's parts are bounded by its length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.llm.tables import small_batches
from eventpulse.llm.words import slices

KINDS = ("assign", "access", "hex", "name", "endpoint", "mixed")
STRONG = 3
SCOPE = 120
MASK = "[SECRET]"

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
NAME = re.compile(r"""(?ai:\b(?:user(?:name)?|login|account|client_id|access_key_id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,64})""")
ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+]{1,15}://[^\s"'<>]{4,}|(?ai:\b(?:host|endpoint|server))["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]{4,255})""")
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

Span = tuple[int, int, int]


def _strong(text: str) -> list[list[Span]]:
    assigned = ASSIGN.finditer(text) if ":" in text or "=" in text else ()
    return [
        [(m.start(), 0, m.end()) for m in assigned if len(m[2]) >= 8],
        [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else [],
        [(m.start(), 2, m.end()) for m in HEX.finditer(text)],
    ]


def _is_mixed(run: str) -> bool:
    kinds = (str.islower, str.isupper, str.isdigit)
    return all(any(map(kind, run)) for kind in kinds) and len(set(run)) >= 10


def within(span: Span, parts: list[Span], reach: int = SCOPE) -> bool:
    """Whether one of the parts (sorted, not overlapping each other) meets the span widened by ``reach``."""
    at = bisect_right(parts, span[0] - reach, key=lambda part: part[2])
    return at < len(parts) and parts[at][0] < span[2] + reach


def spans_of_text(text: str | None) -> list[Span]:
    """(start, kind number, end) of all reported spans, sorted."""
    if not text:
        return []
    assign, access, hexes = strong = _strong(text)
    named = ":" in text or "=" in text
    weak = [
        [(m.start(), 3, m.end()) for m in NAME.finditer(text)] if named else [],
        [(m.start(), 4, m.end()) for m in ENDPOINT.finditer(text)] if named else [],
        [(m.start(), 5, m.end()) for m in MIXED.finditer(text) if _is_mixed(m[0])],
    ]
    names, endpoints, mixed = ([s for s in own if not any(within(s, part, 0) for part in strong)] for own in weak)
    mixed = [s for s in mixed if not any(within(s, part, 0) for part in (names, endpoints))]
    reported = [s for s in mixed if any(within(s, part) for part in (access, names, endpoints))]
    secrets = (assign, hexes, mixed)
    reported += [s for own in (names, endpoints) for s in own if any(within(s, part) for part in secrets)]
    return sorted([*assign, *access, *hexes, *reported])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of kind, start, end) for each row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            found = [[(KINDS[k], a, b) for a, k, b in spans_of_text(text)] for text in batch.column(1).to_pylist()]
            found = [[dict(zip(("kind", "start", "end"), span, strict=True)) for span in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def mask_text(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def masked(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every reported span replaced by MASK; n_chars, if there, follows the new text."""
    small_batches(docs.sparkSession)
    names = docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            place = names.index("text")
            texts = batch.column(place).to_pylist()
            found = [spans_of_text(text) for text in texts]
            new = [mask_text(text, own) if own else text for text, own in zip(texts, found, strict=True)]
            columns = list(batch.columns)
            columns[place] = pa.array(new, batch.schema.field(place).type)
            if "n_chars" in names:
                at = names.index("n_chars")
                old = columns[at].to_pylist()
                count = [len(text) if own else n for text, own, n in zip(new, found, old, strict=True)]
                columns[at] = pa.array(count, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(scan, docs.schema)
