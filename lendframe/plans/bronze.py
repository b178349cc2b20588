"""Raw archives to all-text bronze tables, one ``source=`` partition per table in them."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..eras import DERIVED_COLUMNS, INDEX_COLUMN, PRE2007, Era
from ..functions import codes
from ..operators.columns import drop_present, fix_panel_headers
from ..operators.identity import index_label
from ..session import cut_lineage
from ..sources.archives import expand_members, list_members
from ..sources.delimited import (
    fail_on_long_lines,
    field_count,
    header_columns,
    malformed_lines,
    read_text_table,
    source_name,
    with_row_numbers,
)
from ..sources.layers import drop_source, path_exists, write_partitioned, written_partitions
from ..sources.layout import Layout
from ..sources.listing import (
    archives_for_years,
    list_files,
    pending_sources,
    pre2007_archives,
    sources_of_years,
)

logger = logging.getLogger(__name__)
RESCUED = "_rescued_line"
TABLE_FACTS = ("_table_source", "_table_year", "_table_type")
LONG_LINES = ("fail", "report", "lossy")


def _archives(spark: SparkSession, layout: Layout, era: Era, dataset: str, first: int, last: int) -> DataFrame:
    if era is PRE2007:
        folder = layout.raw("loans") if dataset == "loans" else f"{layout.root}/raw"
        listing = list_files(spark, folder, "*.zip")
        found = pre2007_archives(listing, dataset, first, last)
        source = F.concat(F.lit(f"{dataset}_"), F.col("year").cast("string"))
    else:
        found = archives_for_years(list_files(spark, layout.raw(dataset), "*.zip"), first, last)
        source = codes.normal_stem(F.col("path"))
    return found.withColumn("source", source)


def archive_members(
    spark: SparkSession, layout: Layout, era: Era, dataset: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """The tables in the archives of the years asked for: ``path, year, member, size, tables, source``.

    The only table of an archive takes the archive's name as source; of several each adds
    its own name, and before 2007 the year comes last.
    """
    archives = _archives(spark, layout, era, dataset, first or era.first_year, last or era.last_year)
    listed = list_members(archives, by_year=era is PRE2007)
    own = F.regexp_replace(F.regexp_replace("member", r"\.[^.]*$", ""), "[^A-Za-z0-9_-]", "_")
    year = F.col("year").cast("string")
    if era is PRE2007:
        several = F.concat(F.lit(f"{dataset}_"), own, F.lit("_"), year)
    else:
        several = F.concat("source", F.lit("__"), own)
    named = F.when(F.col("tables") > 1, several).otherwise(F.col("source"))
    return listed.join(archives.select("path", "year", "source"), ["path", "year"]).withColumn("source", named)


def _with_table_facts(df: DataFrame, tables: DataFrame, numbered: bool) -> tuple[DataFrame, Column, Column]:
    """Rows beside the facts of the table they came from, its file type and its year; ``numbered`` adds ``_row``.

    The facts are joined as a table, so the plan stays small however many tables there are. If
    one has no known type, any row of the group stops the job.
    """
    if numbered:
        df = with_row_numbers(df, "_row")
    named = [F.col(c).alias(n) for c, n in zip(("source", "year"), TABLE_FACTS, strict=False)]
    facts = cut_lineage(tables.select(*named, codes.file_type_post2018(F.col("path"), strict=False).alias(TABLE_FACTS[2]), "path"))
    unknown = facts.filter(F.col(TABLE_FACTS[2]).isNull()).select("path").first()
    kind = F.col(TABLE_FACTS[2]) if unknown is None else codes.file_type_post2018(F.lit(unknown["path"]))
    # one short row per table
    joined = df.join(F.broadcast(facts.drop("path")), F.col("source") == F.col(TABLE_FACTS[0]), "left")
    return joined, kind, F.col(TABLE_FACTS[1])


def build_bronze(
    spark: SparkSession,
    layout: Layout,
    era: Era,
    dataset: str,
    first: int | None = None,
    last: int | None = None,
    replace: bool = False,
    long_lines: str | None = None,
) -> int:
    """Write the tables not written yet (or all) and return how many there were.

    Tables that share a delimiter and a header are read and written by one plan. With
    ``replace``, sources of these years that no archive holds any more are removed.

    ``long_lines`` says what becomes of lines with more fields than columns: ``fail`` stops
    the import, ``report`` keeps their leading fields and writes the whole lines to the
    layout's rescued table, ``lossy`` keeps the leading fields. Before 2007 lines are broken
    so often that ``lossy`` is the default, else it is ``fail``.
    """
    long_lines = long_lines or ("lossy" if era is PRE2007 else "fail")
    if long_lines not in LONG_LINES:
        raise ValueError(f"unknown treatment of long lines: {long_lines}")
    target = layout.bronze(dataset, era.name)
    members = cut_lineage(archive_members(spark, layout, era, dataset, first, last))
    alike = [r["source"] for r in members.groupBy("source").count().filter("count > 1").collect()]
    if alike:
        raise ValueError(f"several tables would become one source: {alike}")
    written = written_partitions(spark, target)
    if replace and path_exists(spark, layout.raw(dataset if era is not PRE2007 or dataset == "loans" else "")):
        of_years = written.filter(sources_of_years(first or era.first_year, last or era.last_year))
        for row in of_years.join(members, "source", "left_anti").collect():
            drop_source(spark, target, row["source"])
    todo = pending_sources(members, written, replace)
    expanded = cut_lineage(expand_members(todo, layout.staging(dataset, era.name)))
    # one short row per table; the heads are cut to their header line first
    header = F.regexp_replace(F.substring_index("head", "\n", 1), "\r$", "")
    tables = expanded.select("staged", "source", "delimiter", header.alias("header")).collect()
    groups: dict[tuple[str, str], list] = {}
    for m in tables:
        groups.setdefault((m["delimiter"] or ",", m["header"]), []).append(m)
    for (delimiter, header_line), group in groups.items():
        columns = header_columns(header_line, delimiter)
        paths = [m["staged"] for m in group]
        rescued = None if long_lines == "lossy" else RESCUED
        df = read_text_table(spark, paths, delimiter, columns, rescued=rescued)
        if long_lines == "fail":
            df = fail_on_long_lines(df, RESCUED, delimiter, len(columns))
        # the folder of a staged table is its source
        df = df.withColumn("source", source_name())

        if era.name == "post2018":
            of_group = (F.coalesce(F.nullif("delimiter", F.lit("")), F.lit(",")) == delimiter) & (header == header_line)
            df, kind, year = _with_table_facts(df, expanded.filter(of_group), dataset == "loans")
            df = df.withColumn("file_type", kind)
            if dataset == "loans":
                index = index_label(year, F.col("file_type"), F.col("_row"))
                df = df.withColumn(INDEX_COLUMN, index).drop("_row")
            df = df.drop(*TABLE_FACTS)
            if dataset == "panel":
                df = fix_panel_headers(df)
            df = drop_present(df, [*DERIVED_COLUMNS, *era.tracts])
        if long_lines != "report":
            write_partitioned(df, target, ["source"])
            continue
        is_long = F.col(RESCUED).isNotNull() & (field_count(F.col(RESCUED), delimiter) > len(columns))
        seen = Observation()
        write_partitioned(df.observe(seen, F.count_if(is_long).alias("long")).drop(RESCUED), target, ["source"])
        if seen.get["long"]:
            logger.warning("%d lines with more than %d fields in %d tables, the first %s", seen.get["long"], len(columns), len(paths), paths[0])
            scan = read_text_table(spark, paths, delimiter, columns, rescued=RESCUED)
            lines = malformed_lines(scan, RESCUED, delimiter, len(columns)).filter("kind = 'long'")
            source = F.element_at(F.split("file", "/"), -2)
            write_partitioned(lines.withColumn("source", source), layout.rescued(dataset, era.name), ["source"])
    return len(tables)
