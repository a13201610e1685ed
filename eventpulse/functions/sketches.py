"""Bloom sketches as column expressions: bitmaps of 32768 bits, built by an aggregate and tested in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of one sketch, as bitmap_construct_agg() makes it.
SKETCH_BITS = 32768
#: Bits that a key sets in its sketch; four places of 15 bits come from one hash.
PLACES = 4


def key_bucket(key: str | Column, buckets: int | Column) -> Column:
    """The bucket of a key among ``buckets``."""
    return F.pmod(F.xxhash64(key), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def key_segment(key: str | Column, segments: int | Column) -> Column:
    """The sketch of its bucket that a key belongs to, independent of the bucket."""
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(segments) if isinstance(segments, int) else segments).cast("int")


def key_places(key: str | Column) -> Column:
    """The bits that a key sets, as an array."""
    h = F.xxhash64(key, F.lit(2))
    return F.array(*[F.shiftrightunsigned(h, 15 * k).bitwiseAND(SKETCH_BITS - 1) for k in range(PLACES)])


def bitmap_words(bits: str) -> Column:
    """A bitmap as 512 longs, the first byte of each highest."""
    word = f"cast(conv(hex(substring({bits}, 8 * i + 1, 8)), 16, -10) as bigint)"
    return F.expr(f"transform(sequence(0, {SKETCH_BITS // 64 - 1}), i -> {word})")


def holds(words: str | Column, place: Column) -> Column:
    """Whether the bit is set in bitmap_words()."""
    inside = 56 - 8 * F.floor(place % 64 / 8) + place % 8
    return F.getbit(F.get(words, F.floor(place / 64).cast("int")), inside.cast("int")) == 1


def holds_all(words: str | Column, key: str | Column) -> Column:
    """Whether the key may be in the sketch: False is certain, True is wrong for about 1 of 400 keys at 16 bits a key."""
    return F.forall(key_places(key), lambda place: holds(words, place))
