"""Row splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import col

PARTS = 10_000


def unit_hash(*parts: Column) -> Column:
    """Uniform number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(2.0**53)


def unit_digest(*parts: Column) -> Column:
    """Uniform number in [0, 1) with 52 bits from the md5 of the parts, alike in other systems."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def hash_split(
    df: DataFrame, key: str, train_share: float = 0.7, seed: int = 42, name: str = "i_train"
) -> DataFrame:
    """Mark rows 1 (train) or 0 (test) by a portable hash of a unique key."""
    digest = F.md5(F.concat_ws("|", col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % PARTS
    return df.withColumn(name, (part < int(train_share * PARTS)).cast("int"))
