"""Silver kept up to date as bronze sources arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..eras import Era
from ..plans.silver import outdated_sources, write_sources
from ..sources.layers import read_bronze
from ..sources.layout import Layout


def refresh_silver(
    spark: SparkSession, layout: Layout, era: Era, dataset: str, checkpoint: str
) -> StreamingQuery:
    """Bring silver up to the bronze sources as they are, then stop.

    The streaming checkpoint knows the files already processed. A batch only names the
    sources that changed, and sources that are gone are named at the start; the batch
    writer makes their partitions anew from the sources the ledger names. So batch and
    stream share one table and one ledger, and a batch that runs twice changes nothing.
    """
    source = layout.bronze(dataset, era.name)
    gone = outdated_sources(spark, layout, era, dataset)
    if gone:
        write_sources(spark, layout, era, dataset, F.col("source").isin(gone))
    rows = spark.readStream.schema(read_bronze(spark, source).schema).parquet(source)

    def write(batch: DataFrame, _: int) -> None:
        changed = [r["source"] for r in batch.select("source").distinct().collect()]
        if changed:
            write_sources(spark, layout, era, dataset, F.col("source").isin(changed))

    return (
        rows.select("source")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
