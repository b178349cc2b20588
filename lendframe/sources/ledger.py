"""What bronze sources hold and what silver partitions were made of.

Two small tables, a version of each per import:

* ``contents``: every bronze source with a stamp of its files and its rows per silver
  partition. A source whose stamp is known is never read again to learn this.
* ``written``: every silver partition with the sources, and their rows, that it was made of.

Both have as many rows as sources meet partitions. One import runs at a time. A version counts
once it is complete, so an import that broke off is made good by the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..eras import Era
from .layers import hadoop_folder, path_exists

CONTENTS, WRITTEN = "contents", "written"


def partition_values(era: Era) -> list[T.StructField]:
    """The partition columns of an era's silver tables; an empty text is a null there."""
    kinds = {"activity_year": T.LongType()}
    return [T.StructField(k, kinds.get(k, T.StringType())) for k in era.partition_by]


def ledger_schema(era: Era, name: str) -> T.StructType:
    fields = [T.StructField("source", T.StringType()), *partition_values(era), T.StructField("rows", T.LongType())]
    if name == CONTENTS:
        fields.insert(1, T.StructField("stamp", T.StringType()))
    return T.StructType(fields)


def source_stamps(spark: SparkSession, bronze: str) -> DataFrame:
    """``source, stamp`` of every bronze source, from a listing of its files; nothing is read."""
    schema = "source string, stamp string"
    if not path_exists(spark, bronze):
        return spark.createDataFrame([], schema)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(bronze)
        .select("path", "modificationTime", "length")
    )
    folder = F.element_at(F.split("path", "/"), -2)
    escaped = F.replace(F.substring_index(folder, "source=", -1), F.lit("+"), F.lit("%2B"))
    file = F.xxhash64("path", "modificationTime", "length")
    stamp = F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.bit_xor(file))
    return files.groupBy(F.url_decode(escaped).alias("source")).agg(stamp.alias("stamp"))


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first."""
    if not path_exists(spark, path):
        return []
    files, folder = hadoop_folder(spark, path)
    names = sorted(s.getPath().getName() for s in files.listStatus(folder))
    return [n for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS")]


def read_ledger(spark: SparkSession, ledger: str, era: Era, name: str) -> DataFrame | None:
    """The last complete version, null if there is none."""
    versions = _versions(spark, f"{ledger}/{name}")
    if not versions:
        return None
    return spark.read.schema(ledger_schema(era, name)).parquet(f"{ledger}/{name}/{versions[-1]}")


def write_ledger(df: DataFrame, ledger: str, era: Era, name: str) -> DataFrame:
    """Write the next version and remove all but the one before it."""
    spark, path = df.sparkSession, f"{ledger}/{name}"
    versions = _versions(spark, path)
    number = int(versions[-1].split("-")[0]) + 1 if versions else 1
    target = f"{path}/{number:08d}-{uuid.uuid4().hex[:8]}"
    df.select(*ledger_schema(era, name).names).coalesce(1).write.parquet(target)
    for old in versions[:-1]:
        files, folder = hadoop_folder(spark, f"{path}/{old}")
        files.delete(folder, True)
    return spark.read.schema(ledger_schema(era, name)).parquet(target)


def same_partition(era: Era, left: str, right: str) -> Column:
    """Join condition on the partition columns; null meets null."""
    condition = F.lit(True)
    for key in era.partition_by:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def drop_partitions(spark: SparkSession, target: str, era: Era, values: Sequence[Sequence[object]]) -> None:
    """Remove whole partitions of a silver table, and folders left without any."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in values:
        parts = [name(k, None if v is None else str(v)) for k, v in zip(era.partition_by, row, strict=True)]
        for depth in range(len(parts), 0, -1):
            files, folder = hadoop_folder(spark, "/".join([target, *parts[:depth]]))
            if depth == len(parts):
                files.delete(folder, True)
            elif files.exists(folder) and not len(files.listStatus(folder)):
                files.delete(folder, False)


def partitions_on_disk(spark: SparkSession, target: str, era: Era) -> list[tuple]:
    """Partition values of the folders of a silver table."""
    if not path_exists(spark, target):
        return []
    files, folder = hadoop_folder(spark, "/".join([target, *(f"{k}=*" for k in era.partition_by)]))
    tools = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    found = []
    for status in files.globStatus(folder):
        names = status.getPath().toString().split("/")[-len(era.partition_by) :]
        values = [tools.unescapePathName(n.split("=", 1)[1]) for n in names]
        values = [None if v == tools.DEFAULT_PARTITION_NAME() else v for v in values]
        kinds = partition_values(era)
        found.append(tuple(int(v) if v is not None and isinstance(k.dataType, T.LongType) else v for v, k in zip(values, kinds, strict=True)))
    return found
