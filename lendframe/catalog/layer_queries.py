"""Queries over files: archives, bronze and silver tables, lender files, written from the views and read back.

Each query works in a folder of its own under the shared folder.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..eras import PERIOD_2007_2017, POST2018, PRE2007
from ..plans import imports, lenders as lender_plan
from ..plans.bronze import archive_members as list_archive_members, build_bronze
from ..plans.silver import build_silver
from ..plans.tracts import merge_tracts
from ..session import shared_folder
from ..sources import layers, ledger
from ..sources.archives import _filesystem
from ..sources.layout import Layout
from ..streaming.refresh import refresh_silver
from .queries import query, r6
from .views import view


def scratch(spark: SparkSession) -> Layout:
    return Layout(layers.shared_uri(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}"))


def put_archives(rows: DataFrame, folder: str) -> None:
    """Zip archives of the rows ``archive_name, member, header, line``, by position, one task per archive.

    Rows come sorted and are written as they come, so a task holds one batch of them,
    however large the archive. It is written under a name of its own attempt and then renamed.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, runs in groupby(_runs(batches), itemgetter(0)):
            files, path = _filesystem(f"{folder}/{name}")
            parent, _, file = path.rpartition("/")
            files.create_dir(parent, recursive=True)
            attempt, count = f"{parent}/.{file}.{uuid.uuid4().hex}", 0
            with files.open_output_stream(attempt) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("docs/readme.txt", "not a table")
                for member, parts in groupby(runs, itemgetter(1)):
                    if member is None:
                        count += sum(len(lines) for *_, lines in parts)
                        continue
                    with archive.open(member, "w", force_zip64=True) as out:
                        for k, (_, _, header, lines) in enumerate(parts):
                            out.write(("\n".join([*([header.as_py()] if not k else []), *lines.to_pylist()]) + "\n").encode())
                            count += len(lines)
            files.move(attempt, path)
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([count], pa.int64())], ["archive_name", "rows"])

    names = ["archive_name", "member", "header", "line"]
    dealt = rows.select(*names, "src_pos").repartition("archive_name")
    placed = dealt.sortWithinPartitions("archive_name", "member", F.asc_nulls_last("src_pos")).select(*names)
    placed.mapInArrow(write, "archive_name string, rows long").write.format("noop").mode("overwrite").save()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, str | None, pa.Scalar, pa.Array]]:
    """Archive, member, first header and lines of each stretch of rows of one member."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names, members, headers, lines = (batch.column(c) for c in range(4))
        ends = np.unique(np.concatenate([pc.run_end_encode(c).run_ends.to_numpy() for c in (names, members)])).tolist()
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            yield names[start].as_py(), members[start].as_py(), headers[start], lines[start:end]


def put_yearly(table: DataFrame, folder: str, kind: str) -> None:
    """One Parquet file per year."""
    names = table.columns

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        files, name = _filesystem(f"{folder}/{frame['activity_year'].iloc[0]}_{kind}.parquet")
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(name) as sink:
            pq.write_table(pa.Table.from_pandas(frame[names], preserve_index=False), sink)
        return pd.DataFrame({"rows": [len(frame)]})

    table.groupBy("activity_year").applyInPandas(write, "rows long").write.format("noop").mode("overwrite").save()


# --- archives and bronze ------------------------------------------------------


@query
def archive_members(spark, sf):
    """The tables found in archives, with the source each becomes."""
    layout = scratch(spark)
    put_archives(view(spark, sf, "archive_rows"), layout.raw("loans"))
    found = list_archive_members(spark, layout, POST2018, "loans")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("archive_name"), "year", "member", "size", "tables", "source")


@query
def bronze_rows(spark, sf):
    """Archives to bronze and back, row keys from the place in the file, derived columns gone."""
    layout = scratch(spark)
    put_archives(view(spark, sf, "archive_rows"), layout.raw("loans"))
    build_bronze(spark, layout, POST2018, "loans")
    return layers.read_bronze(spark, layout.bronze("loans", "post2018"))


@query
def bronze_rows_2007_2017(spark, sf):
    """One archive per year of a middle era, pipe-delimited."""
    layout, rows = scratch(spark), view(spark, sf, "lar_2007_2017")
    names = [c for c in rows.columns if c != "derived_race"]
    put_archives(_lines(rows, names, "|", F.concat(F.lit("hmda_"), "as_of_year", F.lit("_nationwide_codes.zip")), F.lit("lar.csv")), layout.raw("loans"))
    build_bronze(spark, layout, PERIOD_2007_2017, "loans")
    return layers.read_bronze(spark, layout.bronze("loans", "period_2007_2017"))


@query
def bronze_rows_pre2007(spark, sf):
    """Yearly archives of the first era, tab-delimited, some lines with fields too many."""
    layout, rows = scratch(spark), view(spark, sf, "lar_pre2007")
    extra = F.when(F.col("src_pos") % 31 == 0, F.lit("\tmore\tfields")).otherwise(F.lit(""))
    archive = F.concat(F.lit("HMDA_LAR_"), "activity_year", F.lit(".zip"))
    lines = _lines(rows, rows.columns, "\t", archive, F.concat(F.lit("HMDA_LAR_"), "activity_year", F.lit(".txt")))
    put_archives(lines.withColumn("line", F.concat("line", extra)), layout.raw("loans"))
    build_bronze(spark, layout, PRE2007, "loans")
    return layers.read_bronze(spark, layout.bronze("loans", "pre2007"))


def _lines(rows: DataFrame, names: list[str], delimiter: str, archive, member) -> DataFrame:
    line = F.concat_ws(delimiter, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    return rows.select("src_pos", archive.alias("archive_name"), member.alias("member"), F.lit(delimiter.join(names)).alias("header"), line.alias("line"))


@query
def malformed_lines(spark, sf):
    """Lines with fields too many, rescued whole while their leading fields go to bronze."""
    layout, rows = scratch(spark), view(spark, sf, "archive_rows")
    extra = F.when(F.col("src_pos") % 41 == 0, F.lit(",one,\"two, more\"")).otherwise(F.lit(""))
    put_archives(rows.withColumn("line", F.concat("line", extra)), layout.raw("loans"))
    build_bronze(spark, layout, POST2018, "loans", long_lines="report")
    rescued = spark.read.parquet(layout.rescued("loans", "post2018"))
    return rescued.select("source", "kind", "fields", "expected", "line")


# --- silver -------------------------------------------------------------------


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "archive_rows").withColumn("source", F.col("archive"))
    return rows.select(
        F.col("src_pos").cast("string").alias("src_pos"), "activity_year", "file_type", "lei", "loan_amount", "income", "loan_to_value_ratio", "source", "archive_year", F.col("src_pos").alias("_at")
    )


def _put_bronze(rows: DataFrame, layout: Layout) -> None:
    layers.write_partitioned(rows.drop("archive_year", "_at"), layout.bronze("loans", "post2018"), ["source"])


def _replace_some(spark: SparkSession, rows: DataFrame, layout: Layout) -> None:
    """Sources of 2019 lose half of their rows and all rows of other years, those of one type of 2021 go."""
    kept = (F.col("archive_year") == 2019) & (F.col("_at") % 2 == 0) & (F.col("activity_year") == "2019")
    _put_bronze(rows.filter(kept), layout)
    gone = rows.filter("archive_year = 2021 AND file_type = 'b'").select("source").distinct()
    for r in gone.collect():
        layers.drop_source(spark, layout.bronze("loans", "post2018"), r["source"])


def _silver_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    df = layers.read_silver(spark, layout.silver("loans", "post2018"), POST2018)
    return df.select(
        F.col("src_pos").cast("bigint").alias("src_pos"), "activity_year", "file_type", "lei", "loan_amount", "income", r6(F.col("combined_loan_to_value_ratio")).alias("combined_loan_to_value_ratio")
    )


def _second_import(spark: SparkSession, sf: str) -> Layout:
    layout, rows = scratch(spark), _bronze(spark, sf)
    _put_bronze(rows, layout)
    build_silver(spark, layout, POST2018, "loans")
    _replace_some(spark, rows, layout)
    build_silver(spark, layout, POST2018, "loans", first=2019, last=2021, replace=True)
    return layout


@query
def silver_second_import(spark, sf):
    """Silver after some sources were replaced and some removed, and their years imported again."""
    return _silver_rows(spark, _second_import(spark, sf))


@query
def silver_ledger(spark, sf):
    """What the ledger says each silver partition was made of after that."""
    layout = _second_import(spark, sf)
    return ledger.read_ledger(spark, layout.ledger("loans", "post2018"), POST2018, ledger.WRITTEN)


@query
def stream_refresh(spark, sf):
    """Silver kept up by the stream: sources arrive, change and go between two runs."""
    layout, rows = scratch(spark), _bronze(spark, sf)
    _put_bronze(rows.filter("archive_year <= 2021"), layout)
    refresh_silver(spark, layout, POST2018, "loans", f"{layout.root}/checkpoint").awaitTermination()
    _put_bronze(rows.filter("archive_year > 2021"), layout)
    _replace_some(spark, rows, layout)
    refresh_silver(spark, layout, POST2018, "loans", f"{layout.root}/checkpoint").awaitTermination()
    return _silver_rows(spark, layout)


@query
def silver_canonical(spark, sf):
    """Stored tables of two shapes read by one list of columns."""
    layout, rows = scratch(spark), _bronze(spark, sf)
    _put_bronze(rows.filter("archive_year < 2021").drop("income"), layout)
    build_silver(spark, layout, POST2018, "loans")
    _put_bronze(rows.filter("archive_year >= 2021"), layout)
    build_silver(spark, layout, POST2018, "loans", first=2021)
    names = ["src_pos", "lei", "loan_amount", "income", "property_value", "activity_year", "file_type"]
    df = layers.read_silver(spark, layout.silver("loans", "post2018"), POST2018, names)
    return df.select(*names)


@query
def import_status(spark, sf):
    """Status per dataset of whole imports: one with archives, one without, one with a file of no known type."""
    layout = scratch(spark)
    rows = view(spark, sf, "archive_rows")
    put_archives(rows, layout.raw("loans"))
    put_archives(rows.withColumn("archive_name", F.concat(F.col("archive_year").cast("string"), F.lit("_unknown.zip"))), layout.raw("panel"))
    status = imports.import_post2018(spark, layout)
    counted = _silver_rows(spark, layout).groupBy().agg(F.count(F.lit(1)).alias("rows"))
    known = spark.createDataFrame(sorted(status.items()), "dataset string, done boolean")
    # datasets without archives are done without a table
    return known.crossJoin(F.broadcast(counted)).select("dataset", "done", F.when(F.col("dataset") == "loans", F.col("rows")).alias("rows"))


# --- lenders and tracts -------------------------------------------------------


@query
def lender_files(spark, sf):
    """Yearly files combined, written as pipe-delimited text and Parquet; the text read back, all of it as text."""
    layout = scratch(spark)
    put_yearly(view(spark, sf, "panel_raw").withColumnsRenamed({"upper": "lei", "topholder_name": "top_holder_name", "topholder_rssd": "top_holder_rssd"}), f"{layout.root}/panel", "panel")
    put_yearly(view(spark, sf, "ts_raw"), f"{layout.root}/ts", "ts")
    lender_plan.combine_post2018(spark, f"{layout.root}/panel", f"{layout.root}/ts", layout.root, 2018, 2024)
    stem = f"{layout.root}/lenders_combined_2018-2024"
    names = spark.read.parquet(f"{stem}.parquet").columns
    return spark.read.option("sep", "|").option("header", True).csv(f"{stem}.csv").select(*names)


@query
def tract_dimension_rows(spark, sf):
    """The stored tract table after two imports that overlap."""
    layout, loans = scratch(spark), view(spark, sf, "lar_wide")
    merge_tracts(loans.filter("src_pos % 3 <> 0"), f"{layout.root}/tracts")
    stored = merge_tracts(loans, f"{layout.root}/tracts")
    return stored.select("activity_year", "census_tract", *(r6(F.col(c)).alias(c) for c in stored.columns[2:]))
