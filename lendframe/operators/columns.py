"""Renames, drops, unions and export projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..eras import ALTERNATE_RENAMES, PANEL_HEADER_FIXES, RENAMES
from ..functions.casts import col


def rename_present(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; two columns for one target is an error."""
    present = {old: new for old, new in pairs.items() if old in df.columns and old != new}
    kept = [c for c in df.columns if c not in present]
    targets = kept + list(present.values())
    clashes = sorted({t for t in targets if targets.count(t) > 1})
    if clashes:
        raise ValueError(f"more than one source column for {clashes}")
    return df.withColumnsRenamed(present)


def rename_legacy(df: DataFrame) -> DataFrame:
    return rename_present(df, RENAMES)


def rename_alternate(df: DataFrame) -> DataFrame:
    return rename_present(df, ALTERNATE_RENAMES)


def fix_panel_headers(df: DataFrame) -> DataFrame:
    return rename_present(df, PANEL_HEADER_FIXES)


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def dashes_to_underscores(df: DataFrame) -> DataFrame:
    return rename_present(df, {c: c.replace("-", "_") for c in df.columns})


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in code-point order."""
    return df.select(*[col(c) for c in sorted(df.columns)])


WIDENING = ("tinyint", "smallint", "int", "bigint", "float", "double")


def common_type(kinds: Iterable[str]) -> str:
    """Widest number type of the kinds, or text if they are not all numbers."""
    kinds = set(kinds)
    if len(kinds) == 1:
        return kinds.pop()
    if not kinds <= set(WIDENING):
        return "string"
    widest = max(kinds, key=WIDENING.index)
    return "double" if widest == "float" and kinds & {"int", "bigint"} else widest


def concat_diagonal(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; missing columns become null and clashing types their common type."""
    frames = list(frames)
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    target = {name: common_type(found) for name, found in kinds.items() if len(found) > 1}
    same = [
        f.select(*[col(c).cast(target[c]).alias(c) if c in target else col(c) for c in f.columns])
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


SHORT_LIMIT = 32_767
INT_LIMIT = 2_147_483_647
NAME_WIDTH = 32
LABEL_WIDTH = 80
WIDE_CODES = ("msa_md", "county_code", "sequence_number")


def export_projection(
    df: DataFrame,
    labels: Mapping[str, str] | None = None,
    value_labels: Mapping[str, Mapping[int, str]] | None = None,
    county_as_text: bool = True,
) -> DataFrame:
    """Short names, labels as column metadata, and narrow types where values fit.

    One aggregate finds which columns fit; a column that does not fit, or holds
    text that is no whole number, keeps its type.
    """
    labels, value_labels = labels or {}, value_labels or {}
    narrow = {c: ("smallint", SHORT_LIMIT) for c in [*value_labels, "activity_year"]}
    narrow.update({c: ("int", INT_LIMIT) for c in WIDE_CODES})
    if county_as_text:
        narrow.pop("county_code")
    narrow = {c: v for c, v in narrow.items() if c in df.columns}
    fits: dict[str, bool] = {}
    if narrow:
        checks = []
        for c, (_, limit) in narrow.items():
            whole = col(c).try_cast("bigint")
            bad = col(c).isNotNull() & (whole.isNull() | ~whole.between(-limit - 1, limit))
            checks.append(F.coalesce(F.bool_or(bad), F.lit(False)).alias(c))
        found = df.agg(*checks).first()
        fits = {c: not found[c] for c in narrow}
    out = []
    for c in df.columns:
        meta: dict[str, object] = {}
        if c in labels:
            meta["label"] = labels[c][:LABEL_WIDTH]
        if c in value_labels:
            meta["values"] = {str(k): v for k, v in value_labels[c].items()}
        value = col(c).try_cast(narrow[c][0]) if fits.get(c) else col(c)
        out.append(value.alias(c[:NAME_WIDTH].replace("-", "_"), metadata=meta))
    return df.select(*out)
