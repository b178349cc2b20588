"""Layered Parquet tables: partitioned writes, canonical reads, lender files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..eras import Era
from ..operators.vintages import keep_releases
from ..session import shared_folder

SMALL_INTEGERS = (
    "total_units",
    "applicant_age",
    "co_applicant_age",
    "applicant_age_above_62",
    "co_applicant_age_above_62",
)
MAX_ROWS_PER_FILE = 20_000_000


def hadoop_folder(spark: SparkSession, path: str):
    """File system and Hadoop path of a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = hadoop_folder(spark, path)
    return files.exists(folder)


def shared_uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the driver's file system names it.

    Off a local master a path of the local disk is refused, as each executor has a disk of its
    own, unless it lies in the checkpoint folder, which the session names as shared.
    """

    def qualified(name: str) -> str:
        files, folder = hadoop_folder(spark, name)
        return folder.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()

    uri = qualified(path)
    if uri.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        if not uri.startswith(f"{qualified(shared_folder(spark))}/"):
            raise ValueError(f"{path} is on the local disk, which executors don't share")
    return uri


def drop_source(spark: SparkSession, path: str, source: str) -> None:
    """Remove one source of a bronze table."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("source", source)
    files, folder = hadoop_folder(spark, f"{path}/{name}")
    files.delete(folder, True)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], balance: bool = False) -> None:
    """Replace the partitions present in ``df``; other partitions stay.

    Bronze sources line up with silver partitions, so by default nothing moves and
    each task appends to the few partitions it meets. ``balance`` evens out file
    sizes through one adaptive shuffle that splits large partitions.
    """
    if balance:
        df = df.hint("rebalance", *keys)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*keys)
        .parquet(path)
    )


def written_partitions(spark: SparkSession, path: str, key: str = "source") -> DataFrame:
    """Partition values of a table, read from its folders alone."""
    empty = spark.createDataFrame([], f"{key} string")
    if not path_exists(spark, path):
        return empty
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = [(plain(n.split("=", 1)[1]),) for n in names if n.startswith(f"{key}=")]
    return spark.createDataFrame(found, f"{key} string") if found else empty


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All sources of a bronze table, columns unioned; every column is text.

    A source is written by one plan, so one footer per source tells its columns;
    merging the schema of every file would open all of them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    source = F.element_at(F.split("path", "/"), -2)
    firsts = [r["path"] for r in files.groupBy(source).agg(F.min("path").alias("path")).collect()]
    schema = spark.read.option("mergeSchema", True).parquet(*firsts).schema
    return spark.read.schema(schema.add("source", T.StringType())).parquet(path)


def silver_schema(era: Era, columns: Sequence[str]) -> T.StructType:
    """Types of the named silver columns of an era."""

    def kind(name: str) -> T.DataType:
        if name == "income" or name in era.integers:
            return T.LongType()
        if name == "debt_to_income_ratio":
            return T.LongType() if era.name == "post2018" else T.StringType()
        if name in SMALL_INTEGERS and era.name == "post2018":
            return T.ShortType()
        return T.DoubleType() if name in era.floats else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in columns])


def read_silver(
    spark: SparkSession, path: str, era: Era, columns: Sequence[str] | None = None
) -> DataFrame:
    """A silver table; given columns are typed canonically, absent ones read as null.

    Without ``columns`` the stored schema is used. The year key comes back as a
    64-bit number either way.
    """
    if columns is not None:
        return spark.read.schema(silver_schema(era, columns)).parquet(path)
    df = spark.read.parquet(path)
    return df.withColumn("activity_year", F.col("activity_year").cast("bigint"))


def read_best_releases(
    spark: SparkSession, path: str, era: Era, columns: Sequence[str] | None = None
) -> DataFrame:
    """A whole silver table cut to the lowest file type per year.

    The choice needs the folder names alone; only the chosen folders are read.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/activity_year=*/file_type=*")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    chosen: dict[object, str] = {}
    for status in files.globStatus(folder):
        year = status.getPath().getParent().getName().split("=", 1)[1]
        kind = status.getPath().getName().split("=", 1)[1]
        if year.isdigit():
            chosen[int(year)] = min(kind, chosen.get(int(year), kind))
    return keep_releases(read_silver(spark, path, era, columns), chosen)


def write_lenders(df: DataFrame, folder: str, first: int, last: int, parquet: bool = True) -> None:
    """Pipe-delimited text, and Parquet if asked, one folder each."""
    stem = f"{folder}/lenders_combined_{first}-{last}"
    text = df.write.mode("overwrite").option("sep", "|").option("header", True)
    # blanks around a value are part of it
    text.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{stem}.csv")
    if parquet:
        df.write.mode("overwrite").parquet(f"{stem}.parquet")

