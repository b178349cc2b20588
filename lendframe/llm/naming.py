"""Names for helper columns beside the columns of any table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each lengthened until no column is called so; case doesn't count."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
