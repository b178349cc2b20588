"""Operators on small frames, edge cases first."""

import glob
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe import session
from lendframe.operators import (
    cleaning,
    columns,
    corrections,
    decomposition,
    harmonize,
    identity,
    lenders,
    market,
    network,
    profiling,
    quantiles,
    reporters,
    vintages,
)


def test_rename_clash_is_an_error(spark):
    both = spark.createDataFrame([("1", "2")], "occupancy string, owner_occupancy string")
    with pytest.raises(ValueError, match="occupancy_type"):
        columns.rename_legacy(both)
    taken = spark.createDataFrame([("1", "2")], "loan_to_value_ratio string, combined_loan_to_value_ratio string")
    with pytest.raises(ValueError, match="combined_loan_to_value_ratio"):
        columns.rename_legacy(taken)


def test_export_keeps_what_does_not_fit(spark):
    df = spark.createDataFrame(
        [("2020", "70000", "x", "01001"), ("2021", "5", "y", "01003")],
        "activity_year string, loan_type string, `a-b` string, county_code string",
    )
    out = columns.export_projection(df, {"a-b": "z" * 100}, {"loan_type": {1: "one"}})
    assert dict(out.dtypes) == {
        "activity_year": "smallint", "loan_type": "string", "a_b": "string", "county_code": "string",
    }
    assert len(out.schema["a_b"].metadata["label"]) == 80
    narrow = columns.export_projection(df, county_as_text=False)
    assert dict(narrow.dtypes)["county_code"] == "int"


def test_concat_diagonal_turns_clashes_into_text(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([("3", 4.5)], "x string, z double")
    out = columns.concat_diagonal([a, b])
    assert dict(out.dtypes) == {"x": "string", "y": "int", "z": "double"}
    assert sorted(r["x"] for r in out.collect()) == ["1", "3"]


def test_common_types():
    assert columns.common_type(["int", "bigint"]) == "bigint"
    assert columns.common_type(["bigint", "float"]) == "double"
    assert columns.common_type(["string", "int"]) == "string"
    assert columns.common_type(["double"]) == "double"


def test_harmonize_touches_only_text_and_present_columns(spark):
    df = spark.createDataFrame([("5", 7, "keep")], "loan_amount string, loan_type bigint, other string")
    out = harmonize.harmonize_post2018(df)
    assert out.collect()[0].asDict() == {"loan_amount": 5, "loan_type": 7, "other": "keep"}


def test_geo_needs_its_parts(spark):
    only_tract = spark.createDataFrame([("1.5",)], "census_tract string")
    assert harmonize.geo_pre2018(only_tract).first()["census_tract"] == "1.5"
    df = spark.createDataFrame(
        [("1", "3", "9509.02", "33860.0"), ("56", "NA", "1", None), ("x", "3", "1", "7")],
        "state_code string, county_code string, census_tract string, msa_md string",
    )
    rows = [tuple(r) for r in harmonize.geo_pre2018(df).collect()]
    assert rows == [
        ("01", "01003", "01003950902", "33860"),
        ("56", None, None, None),
        (None, None, None, "00007"),
    ]


def _keyed(spark, keys):
    df = spark.createDataFrame(list(enumerate(keys)), "pos bigint, k string")
    return df.withColumn(identity.RECORD_KEY, F.col("k")).repartition(4)


@pytest.mark.parametrize(
    ("keep", "nulls", "kept"),
    [
        ("last", "keep", {1, 2, 3, 4, 5}),
        ("first", "keep", {0, 1, 2, 4, 5}),
        ("any", "keep", {0, 1, 2, 4, 5}),
        ("none", "keep", {1, 2, 4, 5}),
        ("last", "collapse", {1, 3, 4, 5}),
        ("none", "collapse", {1, 4}),
    ],
)
def test_dedup(spark, keep, nulls, kept):
    df = _keyed(spark, ["a", "b", None, "a", "c", None])
    rows = identity.deduplicate(df, "pos", keep, null_keys=nulls).collect()
    assert {r["pos"] for r in rows} == kept
    assert {r[identity.DEDUP_DROPPED] for r in rows} == {6 - len(kept)}


def test_dedup_needs_a_key(spark):
    with pytest.raises(ValueError, match="record key"):
        identity.deduplicate(spark.range(3), "id")


def test_dedup_cuts_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).withColumn(identity.RECORD_KEY, F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    out = identity.deduplicate(df, "id", count_dropped=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")
    none = identity.deduplicate(df, "id", "none", count_dropped=False)
    assert none._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert out.count() == 1000 - 333


def test_record_key_null_parts_and_missing_columns(spark):
    df = spark.createDataFrame([(" L ", "\tU1 "), ("L", None)], "lei string, universal_loan_identifier string")
    assert [r[identity.RECORD_KEY] for r in identity.add_record_key(df, True).collect()] == ["L||U1", None]
    bare = identity.add_record_key(df.select("lei"), False)
    assert {"respondent_id", "agency_code", "sequence_number"} <= set(bare.columns)
    assert bare.first()[identity.RECORD_KEY] is None


def test_dense_position_over_many_slices(spark):
    rows = [(i * 7 % 10_007, "hot" if i % 3 else f"g{i % 5}") for i in range(5000)]
    df = spark.createDataFrame(rows, "pos bigint, g string").repartition(7)
    out = identity.dense_position(df, ["g"], "pos", rows_per_slice=100).collect()
    assert len(out) == 5000
    by_group = {}
    for r in sorted(out, key=lambda r: r["pos"]):
        by_group.setdefault(r["g"], []).append(r["_position"])
    assert all(v == list(range(len(v))) for v in by_group.values())


def test_na_words_only_in_text(spark):
    df = spark.createDataFrame([("NA   ", 1.0, "NA  ")], "a string, b double, c string")
    assert tuple(cleaning.na_to_null(df).first()) == (None, 1.0, "NA  ")


def test_plausibility_counts_and_bounds(spark):
    df = spark.createDataFrame([(250.0, 1.0), (None, None), (100.0, -5.0), (200.0, 0.0)], "ltv double, dti double")
    rows = cleaning.plausibility_filter(df).collect()
    assert len(rows) == 2
    assert {r["_metadata_plausibility_dropped"] for r in rows} == {2}
    assert cleaning.plausibility_filter(df, literal=True).count() == 4
    assert cleaning.plausibility_filter(df, {"ltv": (None, 300), "dti": (None, None)}).count() == 4


def test_crosswalk_years_and_fan_out(spark):
    loans = spark.createDataFrame([(1, "t1", "2019"), (2, "t1", "2020"), (3, None, "2019")], "id int, census_tract string, activity_year string")
    plain = spark.createDataFrame([("t1", "n1"), ("t1", "n2")], "tract_src string, tract_2020 string")
    assert sorted(r["census_tract"] or "" for r in cleaning.crosswalk_tract(loans, plain).collect()) == ["", "n1", "n1", "n2", "n2"]
    yearly = spark.createDataFrame([("t1", "n1", 2019, 2020), ("t1", "n9", 2019, 2010)], "tract_src string, tract_2020 string, year int, target_year int")
    out = cleaning.crosswalk_tract(loans, yearly)
    assert out.columns == loans.columns
    assert {(r["id"], r["census_tract"]) for r in out.collect()} == {(1, "n1"), (2, "t1"), (3, None)}
    assert cleaning.crosswalk_tract(loans, None) is loans


def test_outlier_flags_skip_flat_columns(spark):
    df = spark.createDataFrame([(1.0, float(i), "x") for i in range(50)] + [(1.0, 1e6, "x")], "rate_spread double, interest_rate double, o string")
    out = cleaning.flag_outliers(df)
    assert "outlier_rate_spread" not in out.columns
    assert [r["interest_rate"] for r in out.filter("outlier_interest_rate").collect()] == [1e6]


def test_exact_quantiles(spark, monkeypatch):
    random.seed(5)
    data = [3.0] * 400 + [random.gauss(0, 50) for _ in range(1501)] + [1e9] * 3
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    ordered = sorted(data)

    def reference(p):
        at = p * (len(ordered) - 1)
        low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    want = [reference(p) for p in probs]
    assert quantiles.exact_quantiles(df, ["v"], probs)["v"] == pytest.approx(want)
    monkeypatch.setattr(quantiles, "PIECES", 30)
    assert quantiles.exact_quantiles(df, ["v"], probs)["v"] == pytest.approx(want)
    empty = df.filter("v > 1e12")
    assert quantiles.exact_quantiles(empty, ["v"], [0.5])["v"] == [None]


def test_quantiles_of_many_columns_and_values(spark, monkeypatch):
    """More than 200,000 distinct values, a sample smaller than the table, infinities, nulls and NaN."""
    monkeypatch.setattr(quantiles, "LOOKED_AT", 5000)
    inf = float("inf")
    odd = F.when(F.col("id") % 4 == 0, F.lit(inf)).when(F.col("id") % 4 == 1, F.lit(-inf)).when(F.col("id") % 4 == 2, F.lit(float("nan")))
    df = spark.range(0, 250_000, 1, 7).select(
        ((F.col("id") * 7919) % 250_007).cast("double").alias("a.b"), F.pow(F.col("id").cast("double"), 3).alias("c"),
        odd.alias("d"), F.lit(None).cast("double").alias("e"), (F.col("id") % 3).alias("f"),
    )
    got = quantiles.exact_quantiles(df, ["a.b", "c", "d", "e", "f"], [0.0, 0.3, 0.5, 1.0])
    want = np.quantile((np.arange(250_000) * 7919) % 250_007, [0.0, 0.3, 0.5, 1.0]).tolist()
    assert got["a.b"] == pytest.approx(want)
    assert got["c"] == pytest.approx(np.quantile(np.arange(250_000.0) ** 3, [0.0, 0.3, 0.5, 1.0]).tolist())
    assert got["d"][:2] == [-inf, -inf] and got["d"][3] == inf
    assert got["e"] == [None] * 4 and got["f"] == [0.0, 0.0, 1.0, 2.0]


def test_quantiles_of_a_heavy_value(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 19_999, F.lit(7.0)).otherwise(F.lit(1.0)).alias("v"))
    assert quantiles.exact_quantiles(df, ["v"], [0.0, 0.5])["v"] == [1.0, 7.0]


def test_outer_join_null_keys_match(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("d", 40)], "k string, v int")
    out = lenders.outer_join(left, right, ["k"], ("_l", "_r"))
    assert out.columns == ["k", "v_l", "v_r"]
    assert {tuple(r) for r in out.collect()} == {("a", 1, 10), (None, 2, 20), ("c", 3, None), ("d", None, 40)}


def test_validate_lenders(spark):
    df = spark.createDataFrame([("2018", "a"), ("2018", "a"), ("2020", "b")], "activity_year string, lei string")
    report = lenders.validate_lenders(df, ["activity_year", "lei"], range(2018, 2022))
    assert report == {"rows": 3, "columns": 2, "missing_key_columns": [], "missing_years": [2019, 2021], "duplicate_keys": 1}


def test_best_releases_after_a_filter(spark):
    df = spark.createDataFrame([(2018, "a", 1), (2018, "b", 2), (2019, "c", 3), (None, "e", 4), (2020, None, 5)], "activity_year int, file_type string, id int")
    assert {r["id"] for r in vintages.best_releases(df).collect()} == {1, 3, 4}
    assert {r["id"] for r in vintages.best_releases(df.filter("id > 1")).collect()} == {2, 3, 4}


def test_best_releases_prunes_partitions(spark, folder):
    df = spark.createDataFrame([(2018, "a", 1), (2018, "b", 2), (2019, "c", 3)], "activity_year int, file_type string, id int")
    df.write.partitionBy("activity_year", "file_type").parquet(f"{folder}/t")
    out = vintages.best_releases(spark.read.parquet(f"{folder}/t"))
    # the stored rows are pruned by the answer of the subquery: folders not wanted may even hold broken files
    files = glob.glob(f"{folder}/t/activity_year=2018/file_type=b/*.parquet")
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "[id" in line)
    assert "array_contains" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert {r["id"] for r in out.collect()} == {1, 3} and files
    read = out.select("id", F.input_file_name().alias("file")).collect()
    assert not any("file_type=b" in r["file"] for r in read)


def test_best_releases_runs_nothing_while_built(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    vintages.best_releases(spark.range(10).selectExpr("id", "2018 as activity_year", "'a' as file_type"))
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_counted_dedup_has_one_shuffle_and_bounds_one_scan(spark, folder, monkeypatch):
    spark.range(1000).withColumn(identity.RECORD_KEY, F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))).write.parquet(f"{folder}/k")
    df, plans = spark.read.parquet(f"{folder}/k"), []
    plain = session.cut_lineage

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(session, "cut_lineage", kept)
    for keep, rows in (("last", 667), ("first", 667), ("none", 666)):
        out = identity.deduplicate(df, "id", keep)
        assert out.count() == rows and out.first()[identity.DEDUP_DROPPED] == 1000 - rows
        assert plans[-1].count("Exchange") == 1 and plans[-1].count("FileScan") == 1
    few = cleaning.plausibility_filter(df.withColumn("loan_amount", F.col("id") * 1000), {"loan_amount": (0, 99_000)})
    assert few.count() == 100 and few.first()[cleaning.PLAUSIBILITY_DROPPED] == 900
    assert plans[-1].count("FileScan") == 1 and "Exchange" not in plans[-1]


def test_dedup_query_sends_only_the_columns_it_returns(spark, folder, monkeypatch):
    from lendframe.catalog.queries import QUERIES

    orders = [(1, 7, 10_000.0), (1 + 9000 * 50, 7, 30_000.0), (2, 7, 20_000.0), (101, 7, 1.0), (202, 7, 1.0), (3, None, 1.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(7, 1)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    plans, plain = [], session.cut_lineage

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(session, "cut_lineage", kept)
    for name, first, dropped in (("dedup_last", {450_001}, 1), ("dedup_first", {1}, 1), ("dedup_none", set(), 2)):
        rows = QUERIES[name](spark, folder).collect()
        assert {r["src_pos"] for r in rows} == {2, 101, 202} | first
        assert {r["_metadata_dedup_dropped"] for r in rows} == {dropped}
        assert {r["hmda_record_key"] is None for r in rows if r["src_pos"] in (101, 202)} == {True}
        assert "o_totalprice" in plans[-1] and "c_nationkey" not in plans[-1]


def test_counted_dedup_sends_a_text_key_once(spark, monkeypatch):
    sent, plain = [], session.cut_lineage

    def kept(df):
        sent.append(df.schema["_row"].dataType.names)
        return plain(df)

    monkeypatch.setattr(session, "cut_lineage", kept)
    rows = [("a", -0.0, 1, "x"), ("a", 0.0, 2, "y"), ("b", 1.0, None, "z"), (None, 1.0, 3, "u"), (None, 1.0, 4, "v"), ("", None, 5, "w")]
    df = spark.createDataFrame(rows, "k string, d double, pos long, v string")
    out = {tuple(r) for r in identity.deduplicate(df, "pos", "first", ("k", "d")).collect()}
    # a key whose copies have no position gives a row of nulls; -0.0 and 0.0 are one key
    assert out == {("a", -0.0, 1, "x", 1), (None, None, None, None, 1), (None, 1.0, 3, "u", 1), (None, 1.0, 4, "v", 1), ("", None, 5, "w", 1)}
    assert sent == [["d", "pos", "v"]]
    first = identity.deduplicate(df, "pos", "first", ("d",)).filter("v = 'x'").first()
    assert math.copysign(1, first["d"]) == -1
    collapsed = {tuple(r)[:4] for r in identity.deduplicate(df, "pos", "last", ("k",), "collapse").collect()}
    assert collapsed == {("a", 0.0, 2, "y"), (None, None, None, None), (None, 1.0, 4, "v"), ("", None, 5, "w")}
    by_text = {tuple(r) for r in identity.deduplicate(df.select("k", "v"), "v", "none", ("k",)).collect()}
    assert by_text == {("b", "z", 2), (None, "u", 2), (None, "v", 2), ("", "w", 2)}


def test_exempt_reporters_bounds(spark):
    rows = [(1, "p", "2024", "1111", "Exempt"), (2, "p", "2024", "1", "3"), (3, "q", "2024", "1", "2"), (4, None, "2024", "Exempt", "1111")]
    df = spark.createDataFrame(rows, "id int, lei string, activity_year string, aus_1 string, loan_term string")
    out = reporters.exempt_reporters(df, key="id").collect()
    assert {(r["id"], r["CountExemptions"], r["AverageExemptions"]) for r in out} == {(1, 2, 1.0), (2, 0, 1.0), (4, 2, 2.0)}


def test_lender_averages_drop_codes(spark):
    rows = [("2020", "a", "1111"), ("2020", "a", "10"), ("2020", "a", "x"), ("2020", "b", "NA")]
    df = spark.createDataFrame(rows, "activity_year string, lei string, income string")
    out = reporters.lender_averages(df, ["income"]).collect()
    assert [tuple(r) for r in out] == [("2020", "a", "income", 10.0, 1)]


def test_histogram_integrates_to_one(spark):
    df = spark.createDataFrame([("y", float(i)) for i in range(37)] + [("one", 5.0), ("one", None)], "g string, v double")
    out = profiling.density_histogram(df, "v", ["g"], bins=10).collect()
    assert len(out) == 20
    assert sum(r["cnt"] for r in out) == 38
    flat = {r["bin"]: r for r in out if r["g"] == "one"}
    assert flat[5]["cnt"] == 1 and flat[5]["density"] == pytest.approx(10.0)


def test_type_candidates(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "x", None), ("-2", "2e5", "3", None), (None, "3", "4.5", None)],
        "a string, b string, c string, d string",
    )
    out = {r["column_name"]: r for r in profiling.type_candidates(profiling.tabulate_values(df)).collect()}
    assert {c: r["candidate"] for c, r in out.items()} == {"a": "integer", "b": "float", "c": "mixed", "d": None}
    assert out["b"]["examples"] == "2e5" and out["c"]["examples"] == "x"


def test_known_corrections_table(spark):
    known = corrections.known_corrections(spark)
    assert known.count() == 16
    loans = spark.createDataFrame(
        [
            (1, "549300CCELEPUO4TOE73", 2018, "a", 90_000_000, 0.045, None),
            (2, "549300JD2HS86SAFVA88", 2018, "a", -99999, 4.5, 8888.0),
            (3, "549300CCELEPUO4TOE73", 2018, "b", 90_000_000, 0.045, 1.0),
        ],
        "HMDAIndex int, lei string, activity_year bigint, file_type string, income bigint, interest_rate double, discount_points double",
    )
    fixed = corrections.correct(loans, known, corrections.RULES)
    out = {r["HMDAIndex"]: r for r in fixed.collect()}
    assert (out[1]["income"], out[1]["interest_rate"]) == (90_000, pytest.approx(4.5))
    assert (out[2]["income"], out[2]["discount_points"]) == (-99999, None)
    assert out[3]["income"] == 90_000 and out[3]["dq_flag"]
    audit = {(r["HMDAIndex"], r["field_name"]): r["correction_type"] for r in corrections.correction_audit(fixed).collect()}
    assert audit == {
        (1, "income"): "lender", (1, "interest_rate"): "lender", (2, "discount_points"): "lender",
        (3, "income"): "rule", (3, "interest_rate"): "rule",
    }


def test_partial_corrections_and_reviews(spark):
    lei, year, kind = "54930057XF33SONJFP81", 2020, "a"
    rows = [(1, lei, year, kind, 950_000), (2, lei, year, kind, 80_000), (3, lei, 2021, kind, 950_000), (4, lei, year, kind, -99999)]
    df = spark.createDataFrame(rows, "id long, lei string, activity_year long, file_type string, income long")
    out = corrections.correct(df, corrections.known_corrections(spark)).orderBy("id").collect()
    assert [r["income"] for r in out] == [950, 80_000, 950_000, -99999]
    terms = [(1, 480), (2, 360), (3, None), (4, -99999)]
    loans = spark.createDataFrame([(i, "5493002W52M3SYLFEX32", 2022, "b", t) for i, t in terms], "id long, lei string, activity_year long, file_type string, loan_term long")
    flagged = corrections.review_flags(loans, corrections.known_reviews(spark)).orderBy("id").collect()
    assert [r["review_flag"] for r in flagged] == [True, False, False, False]
    assert flagged[0]["review_reasons"].startswith("large") and flagged[1]["review_reasons"] is None


def test_volume_rollup_levels(spark):
    df = spark.createDataFrame(
        [("t1", "m", "c1", "s", 5), ("t2", "m", "c1", "s", 7), ("t2", None, "c1", "s", 1)],
        "census_tract string, msa_md string, county_code string, state_code string, loan_amount bigint",
    )
    out = {(r["level"], r["code"]): (r["loans"], r["volume"]) for r in market.volume_rollup(df).collect()}
    assert out == {
        ("census_tract", "t1"): (1, 5), ("census_tract", "t2"): (2, 8), ("msa_md", "m"): (2, 12),
        ("msa_md", None): (1, 1), ("county_code", "c1"): (3, 13), ("state_code", "s"): (3, 13),
    }


def test_rate_gap_with_two_covariates(spark):
    random.seed(3)
    rows = []
    for i in range(400):
        g, a, b = i % 2, random.random(), random.random()
        rows.append((g, a + 0.3 * g, b, 1 + 2 * (a + 0.3 * g) - b + 0.5 * g))
    df = spark.createDataFrame(rows, "g int, a double, b double, y double")
    row = market.rate_gap(df, "g", (1, 0), "y", ["a", "b"]).first()
    assert row["unexplained"] == pytest.approx(0.5)
    assert row["gap"] == pytest.approx(row["explained"] + 0.5)


def test_exempt_loans_survive_cleaning(spark):
    from lendframe.plans.clean import clean_loans

    rows = [(k, "L", f"u{k}", -99999.0 if k % 3 == 0 else 80.0, -99999 if k % 2 else 200_000, -99999.0 if k == 0 else 3.0 + k % 5 / 10) for k in range(60)]
    df = spark.createDataFrame(rows, "src_pos long, lei string, universal_loan_identifier string, combined_loan_to_value_ratio double, loan_amount long, interest_rate double")
    out = clean_loans(df, True, "src_pos").collect()
    assert len(out) == 60 and not any(r["outlier_interest_rate"] for r in out if r["src_pos"])


def test_numbers_too_large_are_null(spark):
    from lendframe.functions.casts import to_double

    values = spark.createDataFrame([("1e999",), ("-1e999",), ("12.5",), ("NaN",)], "t string")
    assert [r[0] for r in values.select(to_double(F.col("t"))).collect()] == [None, None, 12.5, None]


# --- decomposition and network ------------------------------------------------


def _gap_frame(spark, seed=1, n=400):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        group = "ab"[i % 3 == 0]
        x1, x2 = rng.normal(5 + (group == "a"), 2), rng.normal(1e6, 1e5)
        kind, place = rng.choice(["p", "q", "r"], p=[0.2, 0.3, 0.5] if group == "a" else [0.5, 0.3, 0.2]), rng.choice(["u", "v"])
        y = 3 + 0.5 * x1 - 1e-6 * x2 + {"p": 0.0, "q": 1.0, "r": -2.0}[kind] + 0.3 * (place == "v") + rng.normal(0, 0.1) + 0.7 * (group == "a")
        rows.append((group, float(y), float(x1), float(x2), str(kind), str(place)))
    return rows, spark.createDataFrame(rows, "g string, y double, x1 double, x2 double, kind string, place string").repartition(3)


def test_decomposition_equals_least_squares(spark):
    rows, df = _gap_frame(spark)
    out = {r.covariate: r.contribution for r in decomposition.rate_decomposition(df, "g", ("a", "b"), "y", ["x1", "x2"], ["kind", "place"]).collect()}

    def design(group):
        own = [r for r in rows if r[0] == group]
        x = np.array([[1, r[2], r[3], r[4] == "q", r[4] == "r", r[5] == "v"] for r in own], float)
        return x, np.array([r[1] for r in own])

    (xa, ya), (xb, yb) = design("a"), design("b")
    slopes = np.linalg.lstsq(xb, yb, rcond=None)[0]
    moves = slopes * (xa.mean(axis=0) - xb.mean(axis=0))
    expected = {"x1": moves[1], "x2": moves[2], "kind": moves[3] + moves[4], "place": moves[5], "(gap)": ya.mean() - yb.mean()}
    expected["(unexplained)"] = expected["(gap)"] - moves.sum()
    assert set(out) == set(expected)
    for name, value in expected.items():
        assert out[name] == pytest.approx(value, abs=1e-6)
    assert out["(unexplained)"] == pytest.approx(0.7, abs=0.05)


def test_decomposition_of_one_covariate_equals_rate_gap(spark):
    _, df = _gap_frame(spark)
    one = market.rate_gap(df, "g", ("a", "b"), "y", ["x1"]).first()
    many = {r.covariate: r for r in decomposition.rate_decomposition(df, "g", ("a", "b"), "y", ["x1"]).collect()}
    assert many["x1"].contribution == pytest.approx(one["explained"])
    assert many["(unexplained)"].contribution == pytest.approx(one["unexplained"])
    assert many["x1"].share + many["(unexplained)"].share == pytest.approx(1)


def test_decomposition_leaves_nulls_out_and_refuses_dependent_covariates(spark):
    rows, df = _gap_frame(spark)
    odd = spark.createDataFrame([("a", None, 1.0, 1.0, "p", "u"), ("b", 1.0, None, 1.0, "p", "u"), ("b", 1.0, 1.0, 1.0, None, "u"), ("b", float("nan"), 1.0, 1.0, "p", "u"), (None, 1.0, 1.0, 1.0, "p", "u")], df.schema)
    args = (("a", "b"), "y", ["x1"], ["kind"])
    assert decomposition.rate_decomposition(df.unionAll(odd), "g", *args).collect() == decomposition.rate_decomposition(df, "g", *args).collect()
    with pytest.raises(ValueError, match="twice is fixed"):
        decomposition.rate_decomposition(df.withColumn("twice", 2 * F.col("x1") + 1), "g", ("a", "b"), "y", ["x1", "twice"])
    with pytest.raises(ValueError, match="same = v is fixed"):
        decomposition.rate_decomposition(df.withColumn("same", F.col("place")), "g", ("a", "b"), "y", [], ["place", "same"])
    with pytest.raises(ValueError, match="no rows"):
        decomposition.rate_decomposition(df, "g", ("a", "z"), "y", ["x1"])
    with pytest.raises(ValueError, match="combinations"):
        decomposition.rate_decomposition(spark.range(40_000).selectExpr("'a' as g", "1.0 as y", "id as k"), "g", ("a", "b"), "y", [], ["k"])


def test_network_rank_equals_power_iteration(spark):
    rng = np.random.default_rng(3)
    edges = sorted({(f"l{rng.integers(12)}", f"m{rng.integers(9)}") for _ in range(60)} | {("hub", f"m{k}") for k in range(9)} | {("same", "m0"), ("x", "same")})
    weights = [float(rng.integers(1, 9)) for _ in edges]
    doubled = [(*e, w / 2) for e, w in zip(edges, weights)] * 2 + [("n", None, 1.0), (None, "m1", 1.0), ("zero", "m1", 0.0)]
    out = network.network_rank(spark.createDataFrame(doubled, "left string, right string, weight double"), damping=0.5, tolerance=1e-7)
    found = {(r.side, r.node): r for r in out.collect()}
    nodes = sorted({("left", a) for a, _ in edges} | {("right", b) for _, b in edges})
    at = {n: k for k, n in enumerate(nodes)}
    joint = np.zeros((len(nodes), len(nodes)))
    for (a, b), w in zip(edges, weights):
        joint[at["left", a], at["right", b]] = joint[at["right", b], at["left", a]] = w
    scores = np.full(len(nodes), 1 / len(nodes))
    for _ in range(500):
        scores = 0.5 / len(nodes) + 0.5 * joint @ (scores / joint.sum(axis=0))
    assert set(found) == set(nodes)
    for n, score in zip(nodes, scores):
        assert found[n].score == pytest.approx(score, abs=1e-7)
        assert found[n].degree == (joint[at[n]] > 0).sum() and found[n].strength == pytest.approx(joint[at[n]].sum())
    assert sum(r.score for r in found.values()) == pytest.approx(1)
    assert network.network_rank(spark.createDataFrame([], "left string, right string, weight double")).count() == 0
