"""All-text delimited scans with per-file row numbers."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from ..functions import codes
from ..session import cut_lineage


def header_columns(head: str, delimiter: str) -> list[str]:
    """Column names of a text head."""
    return next(csv.reader(io.StringIO(head), delimiter=delimiter), [])


def read_text_table(
    spark: SparkSession,
    paths: Sequence[str] | str,
    delimiter: str,
    columns: Sequence[str],
    encoding: str = "UTF-8",
    rescued: str | None = None,
) -> DataFrame:
    """Every column as text, no inference, one header line per file.

    Bytes that are no text become the replacement character, short lines are filled
    with null. Extra fields don't fit the columns: with ``rescued`` a column of that name
    holds the whole line where a line has more or fewer fields than there are columns
    (see ``malformed_lines``), without it extra fields are lost. Line breaks inside quotes
    are not supported, so large files stay splittable.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read
    if rescued is not None:
        if rescued in columns:
            raise ValueError(f"a column is named like the one for rescued lines: {rescued}")
        schema = schema.add(rescued, T.StringType())
        # a pruned scan would count the wanted fields alone
        reader = reader.option("columnNameOfCorruptRecord", rescued).option("columnPruning", False)
    return (
        reader.schema(schema)
        .option("header", True)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def field_count(line: Column, delimiter: str) -> Column:
    """Fields of a line; delimiters inside quotes don't count."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def fail_on_long_lines(df: DataFrame, rescued: str, delimiter: str, expected: int) -> DataFrame:
    """The scan without its rescued column; the job stops at a line with more fields than columns."""
    line = F.col(rescued)
    fields = field_count(line, delimiter)
    message = F.concat(
        fields.cast("string"), F.lit(f" fields instead of {expected} in "), F.col("_metadata.file_path"), F.lit(": "), F.left(line, F.lit(200))
    )
    first = df.columns[0]
    checked = F.when(line.isNotNull() & (fields > expected), F.raise_error(message).cast("string")).otherwise(F.col(f"`{first}`"))
    return df.withColumn(first, checked).drop(rescued)


def malformed_lines(df: DataFrame, rescued: str, delimiter: str, expected: int) -> DataFrame:
    """``file, fields, expected, kind`` (``long``, ``short``) and ``line`` of the lines that a scan rescued.

    A long line has more fields than its file has columns: the fields beyond are in no column of
    the scan. A short line lost nothing. Where fields and columns agree after all, as with
    a quote that is not closed, the kind is ``odd``.
    """
    fields = field_count(F.col(rescued), delimiter)
    kind = F.when(fields > expected, "long").when(fields < expected, "short").otherwise("odd")
    # a scan of the rescued column alone is refused, so a first field is read with it
    parsed = F.length(F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))) >= 0
    return df.filter(F.col(rescued).isNotNull() & parsed).select(
        F.col("_metadata.file_path").alias("file"), fields.alias("fields"), F.lit(expected).alias("expected"), kind.alias("kind"), F.col(rescued).alias("line")
    )


def with_row_numbers(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Zero-based row number within each source file, without a sort or a shuffle.

    ``df`` must be an unfiltered file scan. Task-local ids count rows in scan order;
    one small aggregate per file block turns them into offsets. Both passes must see
    the same blocks: a row whose block is unknown or overrun stops the job rather
    than get a wrong number (raise ``spark.sql.files.minPartitionNum`` to a fixed
    value if executors come and go between the passes).
    """
    marked = df.withColumns(
        {
            "_file": F.xxhash64(F.col("_metadata.file_path")),
            "_block": F.col("_metadata.file_block_start"),
            "_id": F.monotonically_increasing_id(),
        }
    )
    blocks = marked.groupBy("_file", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("_file").alias("_f"),
        F.col("_block").alias("_b"),
        "_first",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b"))
    joined = marked.join(cut_lineage(offsets), same, "left")
    local = F.col("_id") - F.col("_first")
    sound = (local >= 0) & (local < F.col("_rows"))
    position = F.when(sound, local + F.col("_offset")).otherwise(
        F.raise_error(F.lit("file blocks changed between two passes")).cast("bigint")
    )
    return joined.withColumn(name, position).drop(
        "_file", "_block", "_id", "_f", "_b", "_first", "_rows", "_offset"
    )


def source_name() -> Column:
    """Staging folder of the file a row came from."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)


def source_stem() -> Column:
    return codes.normal_stem(F.col("_metadata.file_path"))
