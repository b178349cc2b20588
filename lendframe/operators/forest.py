"""Isolation forest: trees grown from bounded samples, rows scored in parallel."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..eras import INDEX_COLUMN
from ..functions.casts import col
from ..session import cut_lineage
from .cleaning import fill_null, medians, sentinel_to_null
from .quantiles import exact_quantiles
from .splits import hash_split, unit_digest

# Model settings and the features of the published analysis.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.0025
TRAIN_SHARE = 0.7
SEED = 42
EULER = 0.5772156649
FEATURES = (
    "interest_rate",
    "loan_amount",
    "income",
    "combined_loan_to_value_ratio",
    "debt_to_income_ratio",
    "activity_year",
    "discount_points",
    "lender_credits",
    "property_value",
    "loan_type",
    "loan_purpose",
    "purchaser_type",
    "loan_term",
)
MAX_LENDER_SCORE = 0.01
MIN_LENDER_LOANS = 10

TREES_PER_TASK = 4
#: The rows that trees draw from are about so many times what all trees need together.
POOL = 2
#: A tree ranks about so many times the rows it keeps.
DRAWN = 4
#: Places of a raw score: rows alike in all features get the very same one.
PLACES = 9

NODES = "tree int, node int, feature int, threshold double, path double"


def mean_path(n: float) -> float:
    """Mean depth of a failed search in a binary tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def unit(*parts: object) -> float:
    """``splits.unit_digest`` of constants."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2.0**52


def _grower(features: Sequence[str], height: int, seed: int):
    """Grows one tree. The root is node 1, below node n are 2n and 2n + 1.

    Feature and threshold of a node come from digests of seed, tree and node, so a tree
    depends on its rows alone, not on their order. Leaves have feature -1.
    """

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        values = pdf[list(features)].to_numpy(dtype=float)
        rows: list[tuple] = []
        queue = [(1, 0, np.arange(len(values)))]
        for node, depth, members in queue:
            inside = values[members]
            low, high = inside.min(axis=0), inside.max(axis=0)
            split = np.flatnonzero(high > low)
            if depth >= height or not len(split):
                rows.append((tree, node, -1, math.inf, depth + mean_path(len(members))))
                continue
            feature = int(split[int(unit(seed, tree, node, "feature") * len(split))])
            span = float(high[feature] - low[feature])
            threshold = float(low[feature]) + unit(seed, tree, node, "threshold") * span
            over = inside[:, feature] > threshold
            rows.append((tree, node, feature, threshold, 0.0))
            queue += [(2 * node, depth + 1, members[~over]), (2 * node + 1, depth + 1, members[over])]
        return pd.DataFrame(rows, columns=[part.split()[0] for part in NODES.split(", ")])

    return grow


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node); leaves have feature -1."""

    features: tuple[str, ...]
    sample: int
    height: int
    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray

    def raw_scores(self, values: np.ndarray) -> np.ndarray:
        """``-2^(-mean depth / expected depth)``; lower is more unusual."""
        trees = np.arange(len(self.feature))
        at = np.ones((len(values), len(trees)), dtype=np.int32)
        rows = np.arange(len(values))[:, None]
        for _ in range(self.height):
            feature = self.feature[trees, at]
            over = values[rows, feature] > self.threshold[trees, at]
            at = np.where(feature < 0, at, 2 * at + over)
        depth = self.path[trees, at].mean(axis=1)
        return np.round(-np.power(2.0, -depth / mean_path(self.sample)), PLACES)

    def scorer(self, spark: SparkSession) -> Column:
        """Column expression; only the features travel to Python, in Arrow batches."""
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(batch: pd.DataFrame) -> pd.Series:
            return pd.Series(shared.value.raw_scores(batch.to_numpy(dtype=float)))

        return score(F.struct(*[col(c).cast("double").alias(c) for c in self.features]))


def fit_forest(
    train: DataFrame,
    features: Sequence[str],
    key: str = INDEX_COLUMN,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> Forest:
    """Grow ``trees`` trees, each on ``sample`` rows drawn without replacement.

    A digest of the unique key thins the table to a pool of about POOL times the rows all
    trees need, whatever the table's size; each tree takes the rows of the pool that come
    first by a digest of its own. The trees are the only thing that reaches the driver:
    at most ``trees * 2 * sample`` short rows.
    """
    total = train.count()
    if total < 2:
        raise ValueError("an isolation forest needs at least two rows")
    size = min(sample, total)
    height = max(1, math.ceil(math.log2(size)))
    pool_share = POOL * trees * size / total
    draw_share = DRAWN * size / min(total, POOL * trees * size)
    pool = train.select(col(key).alias("_key"), *[col(c).cast("double").alias(c) for c in features])
    pool = cut_lineage(pool.filter(unit_digest(F.col("_key"), F.lit(seed), F.lit("pool")) < pool_share))
    drawn = (
        pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("draw", unit_digest(F.col("_key"), F.lit(seed), F.col("tree"), F.lit("draw")))
        .filter(F.col("draw") < draw_share)
        .repartition(max(1, trees // TREES_PER_TASK), "tree")
        .withColumn("_rank", F.row_number().over(W.partitionBy("tree").orderBy("draw", "_key")))
        .filter(F.col("_rank") <= size)
        .drop("_rank", "_key", "draw")
    )
    nodes = drawn.groupBy("tree").applyInPandas(_grower(features, height, seed), NODES).toPandas()
    shape = (trees, 2 ** (height + 1))
    arrays = {
        "feature": np.full(shape, -1, dtype=np.int32),
        "threshold": np.full(shape, math.inf),
        "path": np.zeros(shape),
    }
    where = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    for name, array in arrays.items():
        array[where] = nodes[name].to_numpy()
    return Forest(tuple(features), size, height, **arrays)


def isolation_forest(
    loans: DataFrame,
    features: Sequence[str] = FEATURES,
    key: str = INDEX_COLUMN,
    keep: Sequence[str] = ("lei",),
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """Score loans: key, kept columns, ``i_train``, ``anomaly_score``, ``anomaly`` (-1 or 1).

    Sentinels become null and nulls the column median; the forest is fitted on the
    training share and scores every row. Scores are centred on the contamination
    quantile of the training scores, so anomalies are negative.
    """
    absent = [c for c in features if c not in loans.columns]
    if absent:
        raise ValueError(f"no such features: {absent}")
    numbers = loans.select(
        col(key), *[col(c) for c in keep], *[col(c).cast("double").alias(c) for c in features]
    )
    known = cut_lineage(sentinel_to_null(numbers, features))  # read five times below
    middle = medians(known, features)
    empty = [c for c, value in middle.items() if value is None]
    if empty:
        raise ValueError(f"no value at all in {empty}")
    split = hash_split(fill_null(known, middle), key, TRAIN_SHARE, seed)
    forest = fit_forest(split.filter("i_train = 1"), features, key, trees, sample, seed)
    scored = cut_lineage(
        split.select(
            col(key),
            *[col(c) for c in keep],
            "i_train",
            forest.scorer(loans.sparkSession).alias("raw_score"),
        )
    )
    train = scored.filter("i_train = 1")
    offset = exact_quantiles(train, ["raw_score"], [contamination])["raw_score"][0]
    centred = F.col("raw_score") - F.lit(offset)
    return (
        scored.withColumn("anomaly_score", centred)
        .withColumn("anomaly", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))
        .drop("raw_score")
    )


def lender_anomalies(scored: DataFrame) -> DataFrame:
    """Mean score, number of anomalies and number of loans per lender."""
    return scored.groupBy("lei").agg(
        F.avg("anomaly_score").alias("lei_anomaly_score"),
        F.count_if(F.col("anomaly") == -1).alias("lei_anomaly_count"),
        F.count("anomaly").alias("count_lei"),
    )


def lender_anomaly_summary(
    scored: DataFrame,
    max_score: float = MAX_LENDER_SCORE,
    min_loans: int = MIN_LENDER_LOANS,
    top: int = 10,
) -> DataFrame:
    """The lenders whose loans look most unusual on average."""
    unusual = (F.col("lei_anomaly_score") <= max_score) & (F.col("count_lei") >= min_loans)
    return lender_anomalies(scored).filter(unusual).orderBy("lei_anomaly_score", "lei").limit(top)


def anomalous_loans(scored: DataFrame) -> DataFrame:
    """Anomalous loans with their lender's figures, most unusual lenders first."""
    lenders = cut_lineage(lender_anomalies(scored).withColumnRenamed("lei", "_lei"))
    return (
        scored.filter("anomaly = -1")
        .join(lenders, F.col("lei").eqNullSafe(F.col("_lei")))
        .drop("_lei")
        .orderBy("lei_anomaly_score", "lei")
    )
