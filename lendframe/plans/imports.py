"""Import jobs per era: bronze, then silver, with one status per dataset."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..eras import PERIOD_2007_2017, POST2018, PRE2007, Era
from ..sources.layout import Layout
from .bronze import build_bronze
from .silver import build_silver

logger = logging.getLogger(__name__)


def import_era(
    spark: SparkSession,
    layout: Layout,
    era: Era,
    datasets: Sequence[str] | None = None,
    first: int | None = None,
    last: int | None = None,
    replace: bool = False,
    drop_tract_vars: bool = True,
    long_lines: str | None = None,
) -> dict[str, bool]:
    """Success per dataset. A failed dataset skips its silver step; the others go on."""
    results: dict[str, bool] = {}
    datasets = list(datasets or era.datasets)
    for dataset in datasets:
        try:
            build_bronze(spark, layout, era, dataset, first, last, replace, long_lines)
        except Exception:
            logger.exception("bronze %s/%s failed", dataset, era.name)
            results[dataset] = False
    for dataset in datasets:
        if dataset in results:
            continue
        try:
            build_silver(spark, layout, era, dataset, first, last, replace, drop_tract_vars)
            results[dataset] = True
        except Exception:
            logger.exception("silver %s/%s failed", dataset, era.name)
            results[dataset] = False
    return results


def import_post2018(spark: SparkSession, layout: Layout, **options) -> dict[str, bool]:
    return import_era(spark, layout, POST2018, **options)


def import_2007_2017(spark: SparkSession, layout: Layout, **options) -> bool:
    return import_era(spark, layout, PERIOD_2007_2017, **options)["loans"]


def import_pre2007(spark: SparkSession, layout: Layout, **options) -> dict[str, bool]:
    return import_era(spark, layout, PRE2007, **options)
