"""Texts as flat code points, and the sampling and hashing that the classifiers share."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: A sample knows so many label values, the most frequent ones, and so many characters of a text.
LABELS, LEARNT = 500, 100_000
#: Values of the share of rows that a sample keeps are drawn from so many steps.
STEPS = 1 << 30


def flat_points(texts: list[str], before: str = "", after: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, ``before`` put to each and ``after`` to the end; where each starts."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts)) + len(before)
    joined = "".join(before + t for t in texts) if before else "".join(texts)
    points = np.frombuffer((joined + after).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum(counts) - counts


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(divisor)


def drawn(seed: int, doc: str = "doc_id") -> Column:
    """A number from 0 to STEPS - 1 for each id."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(doc)), F.lit(STEPS))


def balanced_sample(rows: DataFrame, label: str, per_class: int, seed: int = 7) -> DataFrame:
    """About ``per_class`` rows of each of the LABELS most frequent label values, at most twice that per value on average.

    One count per label value decides the share that is drawn by a hash of the id; the
    whole sample is bounded by ``2 * per_class`` times the number of values.
    """
    most = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(LABELS)
    counts = {r[label]: r["count"] for r in most.collect()}
    if not counts:
        return rows.limit(0)
    chance = drawn(seed)
    keep = F.lit(False)
    for value, count in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (chance < F.lit(int(STEPS * min(1.0, per_class / count)) + 1)))
    return rows.filter(keep).orderBy(chance, "doc_id").limit(2 * per_class * len(counts))
