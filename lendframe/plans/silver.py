"""Bronze tables to typed, Hive-partitioned silver tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..eras import PERIOD_2007_2017, PRE2007, Era
from ..functions import codes
from ..operators.harmonize import silver_2007_2017, silver_post2018, silver_pre2007
from ..session import cut_lineage
from ..sources.layers import path_exists, read_bronze, write_partitioned, written_partitions
from ..sources.layout import Layout
from ..sources.ledger import (
    CONTENTS,
    WRITTEN,
    drop_partitions,
    ledger_schema,
    partition_values,
    partitions_on_disk,
    read_ledger,
    same_partition,
    source_stamps,
    write_ledger,
)
from ..sources.listing import sources_of_years


def to_silver(bronze: DataFrame, era: Era, drop_tract_vars: bool = True) -> DataFrame:
    """Typed rows of one era; ``bronze`` has a ``source`` column."""
    if era is PRE2007:
        df = silver_pre2007(bronze)
        year = F.regexp_extract("source", "([0-9]{4})$", 1).cast("bigint")
        return df.withColumn("activity_year", year).drop("source")
    if era is PERIOD_2007_2017:
        df = silver_2007_2017(
            bronze, codes.file_type_2007_2017(F.col("source")), drop_tract_vars=drop_tract_vars
        )
        if "activity_year" not in df.columns:
            year = F.regexp_extract("source", "(20[0-9]{2})", 1).cast("bigint")
            df = df.withColumn("activity_year", year)
        return df.drop("source")
    return silver_post2018(bronze).drop("source")


def _contents(spark: SparkSession, bronze: str, ledger: str, era: Era) -> DataFrame:
    """The ledger's ``contents`` brought up to date; only sources not known by their stamp are read."""
    stamps = cut_lineage(source_stamps(spark, bronze))
    known = read_ledger(spark, ledger, era, CONTENTS)
    known = known if known is not None else spark.createDataFrame([], ledger_schema(era, CONTENTS))
    kept = known.join(F.broadcast(stamps), ["source", "stamp"], "left_semi")
    fresh = [r["source"] for r in stamps.join(kept.select("source").distinct(), "source", "left_anti").collect()]
    gone = known.join(stamps, ["source", "stamp"], "left_anti")
    if not fresh and gone.isEmpty():
        return known
    if fresh:
        keys = [F.nullif(F.col(k), F.lit("")).alias(k) if k != "activity_year" else F.col(k) for k in era.partition_by]
        rows = read_bronze(spark, bronze).filter(F.col("source").isin(fresh))
        counted = partition_keys(rows, era).groupBy("source", *keys).agg(F.count(F.lit(1)).alias("rows"))
        kept = kept.unionByName(counted.join(F.broadcast(stamps), "source"))
    return write_ledger(kept, ledger, era, CONTENTS)


def partition_keys(bronze: DataFrame, era: Era) -> DataFrame:
    """``source`` and the silver partition of every bronze row."""
    marked = bronze.withColumn("_source", F.col("source"))
    silver = to_silver(marked, era)
    return silver.select(F.col("_source").alias("source"), *era.partition_by)


def write_sources(
    spark: SparkSession,
    layout: Layout,
    era: Era,
    dataset: str,
    chosen: Column,
    replace: bool = False,
    drop_tract_vars: bool = True,
    balance: bool = False,
) -> bool:
    """Bring silver to what bronze holds now of the chosen sources; false if they touch no partition.

    A file may hold rows of other years than its name says, and a source may be replaced or
    removed. Touched are the partitions that the chosen sources hold now, and those the
    ledger says they were written to before. These are made anew from all sources that hold
    rows of them, and only these sources are read; a touched partition that no source holds
    any more is removed. So after the write every touched partition is what an import of
    all bronze would give.

    ``chosen`` is a condition on ``source``, true also of sources that are gone. With
    ``replace``, partitions that no import has recorded are removed unless a source holds them.
    """
    bronze, target, ledger = layout.bronze(dataset, era.name), layout.silver(dataset, era.name), layout.ledger(dataset, era.name)
    contents = _contents(spark, bronze, ledger, era)
    written = read_ledger(spark, ledger, era, WRITTEN)
    written = written if written is not None else spark.createDataFrame([], ledger_schema(era, WRITTEN))
    keys = list(era.partition_by)
    touched = contents.filter(chosen).select(*keys).unionAll(written.filter(chosen).select(*keys)).distinct()
    if replace:
        recorded = {tuple(r) for r in written.select(*keys).distinct().collect()}
        loose = [p for p in partitions_on_disk(spark, target, era) if p not in recorded]
        if loose:
            unrecorded = spark.createDataFrame(loose, T.StructType(partition_values(era)))
            touched = touched.unionAll(unrecorded).distinct()
    # a row per partition, as many as there are folders
    touched = spark.createDataFrame(touched.collect(), T.StructType(partition_values(era)))
    if touched.isEmpty():
        return False
    meets = same_partition(era, "c", "t")
    now = contents.alias("c").join(F.broadcast(touched.alias("t")), meets, "left_semi")
    sources = [r["source"] for r in now.select("source").distinct().collect()]
    if sources:
        rows = to_silver(read_bronze(spark, bronze).filter(F.col("source").isin(sources)), era, drop_tract_vars)
        same = reduce(and_, [F.nullif(F.col(k).cast("string"), F.lit("")).eqNullSafe(F.col(f"_{k}").cast("string")) for k in keys])
        wanted = F.broadcast(touched.select(*[F.col(k).alias(f"_{k}") for k in keys]))
        write_partitioned(rows.join(wanted, same, "left_semi"), target, keys, balance)
    empty = touched.alias("t").join(F.broadcast(contents.alias("c")), meets, "left_anti").collect()
    drop_partitions(spark, target, era, [tuple(r) for r in empty])
    left = written.alias("w").join(F.broadcast(touched.alias("t")), same_partition(era, "w", "t"), "left_anti")
    write_ledger(left.unionByName(now.select("source", *keys, "rows")), ledger, era, WRITTEN)
    return True


def outdated_sources(spark: SparkSession, layout: Layout, era: Era, dataset: str) -> list[str]:
    """Sources that silver still holds rows of though bronze has none of them."""
    written = read_ledger(spark, layout.ledger(dataset, era.name), era, WRITTEN)
    if written is None:
        return []
    there = source_stamps(spark, layout.bronze(dataset, era.name)).select("source")
    return [r["source"] for r in written.select("source").distinct().join(there, "source", "left_anti").collect()]


def build_silver(
    spark: SparkSession,
    layout: Layout,
    era: Era,
    dataset: str,
    first: int | None = None,
    last: int | None = None,
    replace: bool = False,
    drop_tract_vars: bool = True,
    balance: bool = False,
) -> bool:
    """Write the silver partitions of the years asked for; false if there is nothing to write.

    The sources are those whose name holds one of the years, whether bronze still has them
    or not. All go through one write (see ``write_sources``). Pre-2007 years already written
    are skipped unless ``replace``.
    """
    first, last = first or era.first_year, last or era.last_year
    target = layout.silver(dataset, era.name)
    if not path_exists(spark, layout.bronze(dataset, era.name)):
        return False
    chosen = sources_of_years(first, last)
    if era is PRE2007 and not replace:
        done = [r[0] for r in written_partitions(spark, target, "activity_year").collect()]
        year = F.regexp_extract("source", "([0-9]{4})$", 1)
        chosen = chosen & ~year.isin(done) if done else chosen
    whole = replace and (first, last) == (era.first_year, era.last_year)
    return write_sources(spark, layout, era, dataset, chosen, whole, drop_tract_vars, balance)
