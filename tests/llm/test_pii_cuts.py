"""Thresholds of loose PII kinds come from documents that the trees did not see."""

import math
import random

from eventpulse.llm import pii
from tests.llm import plain


def test_threshold_by_precision():
    trees = pii.grow([((0, d, 0, 0, 0, 0, 1, 1, 0), 100, 90 if d >= 4 else 5) for d in range(8)])
    held = [((0, d, 0, 0, 0, 0, 1, 1, 0), 10, 10 if d >= 4 else 1) for d in range(8)]
    cut = pii.calibrated(trees, held)
    assert cut.precision == 1.0 and cut.recall == 40 / 44 and math.isfinite(cut.threshold)
    # what the fitted table promised does not hold for these
    worse = [((0, d, 0, 0, 0, 0, 1, 1, 0), 10, 5) for d in range(8)]
    assert pii.calibrated(trees, worse) == pii.Cut(math.inf, 0.0, 0.0)
    assert pii.calibrated([], held).threshold == math.inf and pii.calibrated(trees, []).threshold == math.inf


def planted(spark):
    """Card numbers after a hint, some with a wrong last digit, which the strict kind refuses; order numbers elsewhere."""
    rng = random.Random(2)
    rows, added = [], set()
    for i in range(600):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        last = next(d for d in "0123456789" if plain.luhn(digits + d))
        if i % 48 == 0:
            last = str((int(last) + 1) % 10)
            added.add(i)
        card = digits + last
        shown = f"my card {card[:4]} {card[4:8]} {card[8:12]} {card[12:]} expires" if i % 2 or i in added else f"order {digits[:12]} of batch x"
        rows.append((i, shown))
    return spark.createDataFrame(rows, "doc_id long, text string"), added


def test_added_spans(spark):
    docs, added = planted(spark)
    trees, cuts = pii.learn(pii._placed(docs))
    assert trees and math.isfinite(cuts[0].threshold) and cuts[0].precision >= pii.PRECISION and cuts[1].threshold == math.inf
    extra = {r.doc_id for r in pii.find_pii(docs).where("size(spans) > size(strict)").collect()}
    # numbers that look and stand like cards are added, order numbers are not
    assert extra == added
