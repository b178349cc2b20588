"""Outlier models against brute force and planted cases."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.operators import forest, neighbors, splits


def brute_force(points, k, include_self=False):
    out = []
    for i, p in enumerate(points):
        near = sorted(math.dist(p, q) for j, q in enumerate(points) if include_self or i != j)
        out.append(near[k - 1] if len(near) >= k else None)
    return out


def _points(n, seed):
    rng = random.Random(seed)
    points = [(rng.gauss(0, 1000), rng.gauss(0, 1000), float(rng.randint(1, 4))) for _ in range(n)]
    points += [points[0]] * (n // 3)  # a third of the rows are copies of one
    points += [(1e6, -1e6, 1.0), (1e6 + 5, -1e6, 1.0)]
    return points


@pytest.mark.parametrize("include_self", [False, True])
@pytest.mark.parametrize("cell", [32, 1024])
def test_knn_matches_brute_force(spark, monkeypatch, cell, include_self):
    monkeypatch.setattr(neighbors, "CELL_POINTS", cell)
    monkeypatch.setattr(neighbors, "QUERIES_PER_TASK", 40)
    points = _points(360, cell)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id bigint, a double, b double, c double")
    got = neighbors.knn_outliers(df.repartition(5), ["a", "b", "c"], "id", 15, 0.005, include_self)
    scores = {r["id"]: r["knn_distance"] for r in got.collect()}
    want = brute_force(points, 15, include_self)
    assert [scores[i] for i in range(len(points))] == pytest.approx(want)
    limit = np.percentile(want, 99.5)
    flagged = {r["id"] for r in got.filter("outlier").collect()}
    assert flagged == {i for i, v in enumerate(want) if v > limit}


def test_knn_with_too_few_points(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "id int, a double")
    rows = neighbors.knn_outliers(df, ["a"], "id", k=15).collect()
    assert {r["knn_distance"] for r in rows} == {None} and not any(r["outlier"] for r in rows)


def test_forest_ranks_planted_outliers_first(spark):
    rng = random.Random(1)
    rows = [(i, f"L{i % 20}", rng.gauss(4, 0.5), rng.gauss(200, 40)) for i in range(3000)]
    rows += [(3000 + i, "BAD", 400.0 + i, 90_000.0 + i) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, lei string, interest_rate double, loan_amount double")
    df = df.withColumn("loan_amount", F.when((F.col("id") % 50 == 7) & (F.col("lei") != "BAD"), -99999.0).otherwise(F.col("loan_amount")))
    scored = forest.isolation_forest(df, ["interest_rate", "loan_amount"], "id")
    assert scored.columns == ["id", "lei", "i_train", "anomaly_score", "anomaly"]
    worst = [r["lei"] for r in scored.orderBy("anomaly_score").limit(12).collect()]
    assert worst == ["BAD"] * 12
    assert scored.filter("(anomaly = -1) <> (anomaly_score < 0)").count() == 0
    share = scored.filter("i_train = 1 AND anomaly = -1").count() / scored.filter("i_train = 1").count()
    assert share <= 0.01
    first = forest.lender_anomaly_summary(scored).first()
    assert (first["lei"], first["count_lei"]) == ("BAD", 12)
    listed = forest.anomalous_loans(scored)
    assert listed.first()["lei"] == "BAD"


def test_forest_needs_values(spark):
    df = spark.range(50).select("id", F.lit("L").alias("lei"), F.lit(None).cast("double").alias("income"))
    with pytest.raises(ValueError, match="income"):
        forest.isolation_forest(df, ["income"], "id")


def test_forest_samples_without_replacement(spark):
    df = spark.range(5000).select("id", F.col("id").cast("double").alias("x"))
    grown = forest.fit_forest(df, ["x"], "id", trees=8, sample=64)
    assert grown.feature.shape[0] == 8 and grown.height == 6 and grown.sample == 64
    assert (grown.feature[:, 1] == 0).all() and (grown.path > 0).any(axis=1).all()
    scores = grown.raw_scores(np.array([[2500.0], [1e9]]))
    assert scores[1] < scores[0] < 0


def test_mean_path():
    assert forest.mean_path(1) == 0 and forest.mean_path(2) == 1
    assert forest.mean_path(256) == pytest.approx(10.244, abs=1e-3)


def test_split_is_stable_under_partitioning(spark):
    df = spark.range(20_000)
    one = {r["id"] for r in splits.hash_split(df.repartition(3), "id").filter("i_train = 1").collect()}
    two = {r["id"] for r in splits.hash_split(df.coalesce(1), "id").filter("i_train = 1").collect()}
    assert one == two and abs(len(one) / 20_000 - 0.7) < 0.02


def test_workers_have_the_package(folder):
    """A query with Python code on the workers, started from another folder."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = str(Path(__file__).resolve().parent.parent)
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from lendframe.session import local_session\n"
        "import __spark_entry__ as driver\n"
        "spark = local_session(2, memory='2g')\n"
        "print('ROWS', driver.queries()['knn_outlier'](spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


# --- bounds from random buckets -----------------------------------------------


def clustered(n, seed):
    """Clusters of very different density, far strays, and repeated rows."""
    rng = np.random.default_rng(seed)
    centres, widths = rng.normal(0, 50, (12, 3)), rng.choice([0.1, 1.0, 6.0], 12)
    which = rng.integers(12, size=n)
    values = centres[which] + rng.normal(size=(n, 3)) * widths[which, None]
    values[: n // 100] = rng.uniform(-300, 300, (n // 100, 3))
    values[-n // 20 :] = values[n // 2 : n // 2 + n // 20]
    return np.round(values, 3)


@pytest.mark.parametrize("n", [60, 6000])
def test_pruned_outliers_equal_the_exact_ones(spark, n):
    values = clustered(n, n)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)] + [(n, None, 1.0, 1.0)], "id long, a double, b double, c double").repartition(4)
    exact = {r.id: r for r in neighbors.knn_outliers(df, ["a", "b", "c"], "id", contamination=0.02).collect()}
    pruned = {r.id: r for r in neighbors.pruned_knn_outliers(df, ["a", "b", "c"], "id", contamination=0.02).collect()}
    assert set(pruned) == set(exact)
    for i, r in exact.items():
        assert pruned[i].outlier == r.outlier
        if r.knn_distance is not None:
            assert pruned[i].knn_distance >= r.knn_distance - 1e-9
            assert not pruned[i].exact or pruned[i].knn_distance == pytest.approx(r.knn_distance)
    if n > 1000:
        assert sum(r.exact for r in pruned.values()) < n / 4
        rough = {r.id for r in neighbors.pruned_knn_outliers(df, ["a", "b", "c"], "id", contamination=0.02, refine=False).collect() if r.outlier}
        true = {i for i, r in exact.items() if r.outlier}
        assert len(rough & true) >= 0.95 * len(true)


def test_pruned_outliers_of_tables_too_small(spark):
    for n in (0, 1, 5):
        df = spark.createDataFrame([(i, float(i)) for i in range(n)], "id long, a double")
        out = neighbors.pruned_knn_outliers(df, ["a"], "id").collect()
        assert len(out) == n and all(r.knn_distance is None and not r.outlier for r in out)


def lattice(n, seed):
    """Points of a few far slabs, close together within them, as loans are."""
    rng = np.random.default_rng(seed)
    sides = [rng.integers(0, 3, n) * 10_000, rng.integers(0, 4, n) * 10_000, rng.integers(0, 180, n), rng.integers(0, 5, n), rng.integers(0, 7, n)]
    values = np.unique(np.stack(sides, axis=1).astype(float), axis=0)
    return values, rng.integers(1, 4, len(values))


@pytest.mark.parametrize("own", [0, -1])
def test_search_in_a_cell_equals_brute_force(own):
    values, copies = lattice(2500, 5)
    got = neighbors._kth(*neighbors._nearest(values, values, copies, 15, own), 15)
    for i in range(0, len(values), 7):
        far = np.sqrt(((values - values[i]) ** 2).sum(axis=1))
        count = copies + own * (np.arange(len(values)) == i)
        order = np.argsort(far, kind="stable")
        assert got[i] == far[order][np.argmax(np.cumsum(count[order]) >= 15)]


def test_search_in_a_cell_grows_with_its_points():
    """Eight times the points took 64 times as long when each was held against all of its cell."""

    def seconds(n):
        values, copies = lattice(n, 3)
        spans = []
        for _ in range(3):
            start = time.perf_counter()
            neighbors._nearest(values, values, copies, 15, -1)
            spans.append(time.perf_counter() - start)
        return min(spans) / len(values)

    assert seconds(16_000) < 3 * seconds(2000)


def test_splits_leave_points_on_both_sides():
    """More than half of the points at the greatest value: the median alone would cut nothing off."""
    sample = np.array([[9.0, float(i)] for i in range(60)] + [[-90.0, float(i)] for i in range(40)])
    dims, cuts = neighbors._splits(sample, 1)
    over = sample[:, dims[1]] > cuts[1]
    assert 0 < over.sum() < len(sample)


def test_later_trees_look_for_high_bounds_alone(spark, monkeypatch):
    """All points were looked for in every tree; those far below the threshold need one bound only."""
    monkeypatch.setattr(neighbors, "CELL_POINTS", 256)
    looked_for, search = [], neighbors._in_cells

    def counted(*args):
        cells = search(*args)
        looked_for.append(cells.bounded.count())
        return cells

    monkeypatch.setattr(neighbors, "_in_cells", counted)
    values = clustered(3000, 7)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)], "id long, a double, b double, c double")
    pruned = {r.id: r.outlier for r in neighbors.pruned_knn_outliers(df, ["a", "b", "c"], "id", contamination=0.01).collect()}
    assert looked_for[0] == len(np.unique(values, axis=0)) and all(0 < n < looked_for[0] / 8 for n in looked_for[1:])
    exact = {r.id: r.outlier for r in neighbors.knn_outliers(df, ["a", "b", "c"], "id", contamination=0.01).collect()}
    assert pruned == exact
