"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Whether a query's shuffle files are removed at its end.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Session settings that the wide projections and partitioned writes rely on.

    HotSpot never compiles a method above 8000 bytes of bytecode. A fused stage with
    a cast per column is far larger, so it would run interpreted; beyond this limit
    Spark generates small methods instead. A few open writers per task spare the
    sort before a partitioned write, as a task meets few partitions.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Functions that run there refer to its modules, wherever the driver was started.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def local_session(cores: int | str = "*", memory: str = "20g") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lendframe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names; one of our own only on a local master."""
    context = spark.sparkContext
    folder = context._jsc.sc().getCheckpointDir()
    if folder.isDefined():
        return folder.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it from there.

    What follows neither repeats the work nor depends on any executor, reads only the
    columns it needs, and plans joins with the true size. The shuffle files of the write go
    as soon as it is done; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def written_and_measured(df: DataFrame, measure: Column, keep: Column | None = None) -> tuple[DataFrame, object]:
    """``cut_lineage`` of ``df``, of its rows to ``keep`` if given, and an aggregate over all its rows taken on the way.

    The measure belongs to the last stage of the write, whose tasks Spark counts once
    however often one of them runs.
    """
    seen = Observation()
    rows = df.observe(seen, measure.alias("measured"))
    out = cut_lineage(rows if keep is None else rows.filter(keep))
    return out, seen.get["measured"]
