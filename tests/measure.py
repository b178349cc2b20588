
from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import Window as W, functions as F  # noqa: E402

from lendframe.catalog.views import view  # noqa: E402
from lendframe.operators import forest, profiling  # noqa: E402
from lendframe.operators.harmonize import silver_post2018  # noqa: E402
from lendframe.session import local_session  # noqa: E402
from lendframe.sources.delimited import read_text_table, with_row_numbers  # noqa: E402


def clock(name, work, runs=3):
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    print(f"{name}: {sorted(times[1:])[runs // 2]:.2f} s", flush=True)


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raw = view(spark, sf_dir, "lar_raw")
    raw.coalesce(1).write.option("header", True).csv(f"{folder}/csv")
    lines = read_text_table(spark, f"{folder}/csv", ",", raw.columns)
    clock("scan of one text file", lambda: sink(lines))
    clock("row numbers by block offsets", lambda: sink(with_row_numbers(lines)))
    alone = W.partitionBy(F.lit(1)).orderBy(F.col("src_pos").cast("bigint"))
    clock("row numbers by one global window", lambda: sink(lines.withColumn("n", F.row_number().over(alone))))

    raw.write.parquet(f"{folder}/bronze")
    bronze = spark.read.parquet(f"{folder}/bronze")
    clock("bronze to silver, typed projection", lambda: sink(silver_post2018(bronze)))
    clock("value table, one pass", lambda: profiling.tabulate_values(bronze).collect())

    def per_column():
        for c in bronze.columns:
            bronze.groupBy(c).count().orderBy(F.desc("count")).limit(50).collect()

    clock("value table, one job per column", per_column)

    silver_post2018(view(spark, sf_dir, "lar_wide")).repartition(8).write.parquet(f"{folder}/silver")
    loans = spark.read.parquet(f"{folder}/silver")
    features = [c for c in forest.FEATURES if c in loans.columns]
    filled = loans.select("src_pos", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    grown = forest.fit_forest(filled, features, "src_pos")
    clock("isolation forest, fit", lambda: forest.fit_forest(filled, features, "src_pos"))
    rows = loans.count()
    clock(f"isolation forest, score {rows} rows", lambda: sink(filled.select(grown.scorer(spark))))


if __name__ == "__main__":
    main()
