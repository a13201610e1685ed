"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text. Rendering successive prefixes of a
conversation and comparing consecutive outputs locates each turn's span: what was
appended. Where an output does not begin with the one before, the template has
rewritten history; the turn is flagged and its span starts where the outputs part.
Where the text lies within a span is found the same way, by rendering the same prefix
with two probe texts in the turn's place that differ in one character.

Conversations are cut into blocks of BLOCK turn numbers, so that a long one spreads
over tasks; each block is rendered after all turns before it (its context), so a
template may look back as far as it likes. What is rendered grows with the square of
a conversation's length, as it must for a template of which nothing is known, and a
task holds the turns of one conversation up to its block.

Turns are ordered by turn, role and text, null first, so repeated turns have a
defined order. Null texts and roles are empty. Rows with a null conv_id are one
conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventpulse.llm.tables import small_batches

BLOCK = 64
LEARNED = ("assistant",)
Turn = tuple[str, str]

_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>\n", re.DOTALL)


def escape(text: str) -> str:
    """Put one more backslash into everything that looks like a control string."""
    return _CONTROL.sub(r"\1\\\2\3", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def tagged(turns: list[Turn]) -> str:
    """The template: role and text of each turn between control strings."""
    return "".join(f"<s>[INST]{escape(role)}[/INST]{escape(text)}</s>\n" for role, text in turns)


def read_tagged(formatted: str) -> list[Turn]:
    """The turns of a text written by ``tagged``."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _shared(a: str, b: str) -> int:
    """Length of the common beginning, by comparing halves: texts are long and mostly alike."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(render: Callable[[list[Turn]], str], turns: list[Turn], skip: int = 0) -> list[tuple[str, int, int, bool]]:
    """(segment, text start, text end, rewrites history) of each turn after the first ``skip``.

    Start and end are places of the text within the segment, as the template wrote it;
    both are the segment's end for a text that the template leaves out.
    """
    out = []
    before = render(turns[:skip]) if skip else ""

    for k in range(skip, len(turns)):
        now = render(turns[: k + 1])
        rewrites = not now.startswith(before)
        begin = _shared(before, now) if rewrites else len(before)
        one, two = (render([*turns[:k], (turns[k][0], probe)]) for probe in ("a", "b"))
        at = _shared(one, two)
        start = max(at - begin, 0)
        end = max(len(now) - begin - (len(one) - at - 1), start)
        if one == two:  # the template does not show this text
            start = end = len(now) - begin
        out.append((now[begin:], start, end, rewrites))
        before = now
    return out


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with their block, plus for each later block all rows before it as context."""
    block = F.floor(F.col("turn") / BLOCK)
    rows = rows.withColumn("block", block).withColumn("context", F.lit(False))
    order = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    later = F.collect_list("block").over(order.rowsBetween(1, Window.unboundedFollowing))
    blocks = rows.select("conv_id", "block").distinct().withColumn("later", later).where(F.size("later") > 0)
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "later")
    before = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    context = before.select("conv_id", "turn", "role", "text", F.explode("later").alias("block"), F.lit(True).alias("context"))
    return rows.unionByName(context)


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def format_chats(chats: DataFrame, render: Callable[[list[Turn]], str] = tagged, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per block of a conversation, in order of ``block`` (null first).

    conv_id, block, formatted, n_turns, rewrites (turns that changed earlier output)
    and mask: [start, end) places in ``formatted`` whose text is learned from.
    """
    small_batches(chats.sparkSession)
    rows = chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    keys = [F.col("conv_id").asc_nulls_first(), F.col("block").asc_nulls_first()]
    order = [*keys, F.col("context").desc(), F.col("turn").asc_nulls_first(), "role", "text"]
    blocks = _blocks(rows).repartition("conv_id", "block").sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("formatted", pa.string()), ("n_turns", pa.int64()),
                          ("rewrites", pa.int64()), ("mask", pa.list_(pa.list_(pa.int64())))])
        for (conv_id, block), group in groupby(_dicts(batches), key=lambda row: (row["conv_id"], row["block"])):
            group = list(group)
            turns = [(row["role"], row["text"]) for row in group]
            skip = sum(row["context"] for row in group)
            found = locate(render, turns, skip)
            at, mask = 0, []
            for (segment, start, end, _), (role, _) in zip(found, turns[skip:], strict=True):
                if role in learned:
                    mask.append([at + start, at + end])
                at += len(segment)
            row = {"conv_id": conv_id, "block": block, "formatted": "".join(f[0] for f in found), "n_turns": len(found),
                   "rewrites": sum(f[3] for f in found), "mask": mask}
            yield pa.RecordBatch.from_pylist([row], kind)

    return blocks.mapInArrow(write, "conv_id long, block long, formatted string, n_turns long, rewrites long, mask array<array<long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What the output of ``format_chats`` says when read back, one row per conversation.

    Hashes run over a conversation block by block, so a task holds one block at a time.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("block").asc_nulls_first()]
    blocks = formatted.repartition("conv_id").sortWithinPartitions(*order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                          ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites", pa.int64())])
        out = []
        for conv_id, group in groupby(_dicts(batches), key=lambda row: row["conv_id"]):
            turns, loss, n, chars, size, rewrites = sha256(), sha256(), 0, 0, 0, 0
            for row in group:
                text = row["formatted"]
                for role, said in read_tagged(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for start, end in row["mask"]:
                    learned = unescape(text[start:end])
                    loss.update(learned.encode())
                    chars += len(learned)
                size, rewrites = size + len(text), rewrites + row["rewrites"]
            out.append({"conv_id": conv_id, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                        "loss_sha256": loss.hexdigest(), "formatted_chars": size, "rewrites": rewrites})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, kind)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long"
    return blocks.mapInArrow(read, out)
