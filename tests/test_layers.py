"""Raw archives to bronze to silver in a scratch folder."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lendframe.catalog import layer_queries
from lendframe.eras import PERIOD_2007_2017, POST2018, PRE2007
from lendframe.plans import bronze as bronze_plan
from lendframe.plans import lenders as lender_plan
from lendframe.plans import silver as silver_plan
from lendframe.plans.bronze import build_bronze
from lendframe.plans.imports import import_2007_2017, import_era, import_post2018, import_pre2007
from lendframe.plans.silver import build_silver
from lendframe.plans.tracts import merge_tracts
from lendframe.sources.delimited import read_text_table, with_row_numbers
from lendframe.session import shared_folder
from lendframe.sources.layers import drop_source, read_best_releases, read_bronze, read_silver, shared_uri, write_partitioned, written_partitions
from lendframe.sources.ledger import WRITTEN, read_ledger
from lendframe.sources.layout import Layout
from lendframe.sources.listing import (
    archives_for_years,
    list_files,
    pending_sources,
    transfer_plan,
    year_paths,
)
from lendframe.streaming.refresh import refresh_silver

LAR_HEADER = ["activity_year", "lei", "state_code", "county_code", "loan_amount", "income", "loan_to_value_ratio", "derived_sex", "tract_population"]


def lar_text(year, rows, delimiter, extra=()):
    lines = [delimiter.join([*LAR_HEADER, *extra])]
    for i in range(rows):
        income = "Exempt" if i % 5 == 0 else str(50 + i)
        row = [str(year), f"LEI{i % 3}", "DC", f"{11001 + i % 4}.0", str(1000 * i), income, "80.5", "Male", "900"]
        lines.append(delimiter.join([*row, *["7"] * len(extra)]))
    return "\n".join(lines) + "\n"


def put_zip(root, dataset, name, members):
    path = os.path.join(root, "raw", dataset) if dataset else os.path.join(root, "raw")
    os.makedirs(path, exist_ok=True)
    with zipfile.ZipFile(os.path.join(path, name), "w", zipfile.ZIP_DEFLATED) as archive:
        for member, text in members.items():
            archive.writestr(member, text)


@pytest.fixture()
def post2018(folder):
    put_zip(folder, "loans", "2018_public_lar_three_year_csv.zip", {"2018_lar.csv": lar_text(2018, 40, ",")})
    put_zip(folder, "loans", "2018_public_lar_one_year_pipe.zip", {"2018_lar.txt": lar_text(2018, 30, "|")})
    put_zip(
        folder, "loans", "2019_public_lar_csv.zip",
        {"docs/readme.txt": "no", "2019_lar.csv": lar_text(2019, 20, ",", ["loan_type"])},
    )
    put_zip(
        folder, "panel", "2018_public_panel_csv.zip",
        {"2018_panel.csv": "activity_year,upper,topholder_name,assets\n2018,LEI0,Top,5\n"},
    )
    return Layout(folder)


def test_post2018_round_trip(spark, post2018):
    results = import_post2018(spark, post2018)
    assert results == {"loans": True, "panel": True, "transmissal_series": True}

    bronze = read_bronze(spark, post2018.bronze("loans", "post2018"))
    assert set(dict(bronze.drop("source").dtypes).values()) == {"string"}
    assert "derived_sex" not in bronze.columns and "tract_population" not in bronze.columns
    assert bronze.count() == 90
    keys = [r["HMDAIndex"] for r in bronze.orderBy("HMDAIndex").collect()]
    assert keys == [
        *[f"2018a_{i:09d}" for i in range(40)],
        *[f"2018b_{i:09d}" for i in range(30)],
        *[f"2019c_{i:09d}" for i in range(20)],
    ]
    # the row number is the line's place in its file
    row = bronze.filter("HMDAIndex = '2018b_000000017'").first()
    assert row["loan_amount"] == "17000"

    loans = read_silver(spark, post2018.silver("loans", "post2018"), POST2018)
    kinds = dict(loans.dtypes)
    assert kinds["activity_year"] == "bigint" and kinds["income"] == "bigint"
    assert kinds["combined_loan_to_value_ratio"] == "double" and kinds["file_type"] == "string"
    row = loans.filter("HMDAIndex = '2018a_000000005'").first()
    assert (row["income"], row["county_code"], row["loan_type"]) == (-99999, "11002", None)
    assert loans.filter("HMDAIndex = '2019c_000000001'").first()["loan_type"] == 7
    best = read_best_releases(spark, post2018.silver("loans", "post2018"), POST2018)
    counts = {tuple(r) for r in best.groupBy("activity_year", "file_type").count().collect()}
    assert counts == {(2018, "a", 40), (2019, "c", 20)}
    panel = read_silver(spark, post2018.silver("panel", "post2018"), POST2018)
    assert {"lei", "top_holder_name"} <= set(panel.columns)


def test_skip_replace_and_other_years_survive(spark, post2018, folder):
    assert build_bronze(spark, post2018, POST2018, "loans") == 3
    assert build_bronze(spark, post2018, POST2018, "loans") == 0
    assert build_bronze(spark, post2018, POST2018, "loans", replace=True, first=2019, last=2019) == 1
    assert build_silver(spark, post2018, POST2018, "loans")
    put_zip(folder, "loans", "2019_public_lar_csv.zip", {"2019_lar.csv": lar_text(2019, 7, ",")})
    results = import_post2018(spark, post2018, datasets=["loans"], first=2019, last=2019, replace=True)
    assert results == {"loans": True}
    counts = read_silver(spark, post2018.silver("loans", "post2018"), POST2018).groupBy("activity_year").count()
    assert {r["activity_year"]: r["count"] for r in counts.collect()} == {2018: 70, 2019: 7}


def test_a_failed_dataset_does_not_stop_the_others(spark, post2018, folder):
    put_zip(folder, "panel", "2019_unknown.zip", {"x.csv": "a,b\n1,2\n"})
    results = import_post2018(spark, post2018)
    assert results == {"panel": False, "loans": True, "transmissal_series": True}


def test_2007_2017_round_trip(spark, folder):
    header = "as_of_year,respondent_id,agency_code,state_code,county_code,census_tract_number,msamd,loan_amount_000s,applicant_income_000s,population,rate_spread"
    rows = ["2012,1,9,1,3,9509.02,33860,150,NA,900,1.5", "2012,2,5,56,,1.1,,7,20,901,"]
    put_zip(folder, "loans", "hmda_2012_nationwide_all-records_codes.zip", {"lar.csv": "\n".join([header, *rows]) + "\n"})
    layout = Layout(folder)
    assert import_2007_2017(spark, layout)
    loans = read_silver(spark, layout.silver("loans", "period_2007_2017"), PERIOD_2007_2017)
    assert "tract_population" not in loans.columns
    first, second = loans.orderBy("respondent_id").collect()
    assert (first["activity_year"], first["file_type"], first["census_tract"]) == (2012, "d", "01003950902")
    assert (first["loan_amount"], first["income"], first["msa_md"]) == (150_000, None, "33860")
    assert (second["county_code"], second["income"], second["rate_spread"]) == (None, 20_000, None)
    assert import_era(spark, layout, PERIOD_2007_2017, replace=True, drop_tract_vars=False)["loans"]
    kept = read_silver(spark, layout.silver("loans", "period_2007_2017"), PERIOD_2007_2017)
    assert kept.agg(F.sum("tract_population")).first()[0] == 1801


def test_pre2007_round_trip(spark, folder):
    text = b"activity_year\trespondent_id\tagency_code\tstate_code\tcounty_code\tcensus_tract\toccupancy\tloan_amount\n1999\t95-2318940\tC\t6\t37\t12.5\t1\t80\n1999\tM\xfcller\t3\t6\n"
    put_zip(folder, "loans", "HMDA_LAR_1999.zip", {"sub/lar_1999.txt": "x", "HMDA_LAR_1999.txt": text})
    put_zip(folder, "", "HMDA_PANEL.zip", {"panel_1998.txt": "a|activity_year\n8|1998\n", "panel_1999.txt": "a|activity_year\n9|1999\n"})
    layout = Layout(folder)
    results = import_pre2007(spark, layout)
    assert results == {"loans": True, "panel": True, "transmissal_series": True}
    loans = read_silver(spark, layout.silver("loans", "pre2007"), PRE2007).orderBy(F.desc("loan_amount")).collect()
    assert (loans[0]["agency_code"], loans[0]["census_tract"], loans[0]["loan_amount"]) == ("C", "06037001250", 80_000)
    assert loans[0]["occupancy_type"] == 1 and loans[0]["activity_year"] == 1999
    assert loans[1]["county_code"] is None and "�" in loans[1]["respondent_id"]
    panel = read_silver(spark, layout.silver("panel", "pre2007"), PRE2007)
    assert {(r["activity_year"], r["a"]) for r in panel.collect()} == {(1998, "8"), (1999, "9")}
    assert not build_silver(spark, layout, PRE2007, "panel")


def test_row_numbers_across_blocks_and_files(spark, folder):
    for name, rows in (("a.csv", 3000), ("b.csv", 1), ("c.csv", 777)):
        with open(f"{folder}/{name}", "w") as f:
            f.write("n,pad\n")
            f.writelines(f"{i},{'x' * (i % 50)}\n" for i in range(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        df = read_text_table(spark, folder, ",", ["n", "pad"])
        assert df.rdd.getNumPartitions() > 10
        out = with_row_numbers(df).cache()
        assert out.count() == 3778
        assert out.filter("CAST(n AS BIGINT) <> row_number").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_short_long_and_broken_lines(spark, folder):
    with open(f"{folder}/t.csv", "wb") as f:
        f.write(b"a,b,c\n1,2\n1,2,3,4\n\xff,,\"\"\n")
    rows = [tuple(r) for r in read_text_table(spark, f"{folder}/t.csv", ",", ["a", "b", "c"]).collect()]
    assert rows == [("1", "2", None), ("1", "2", "3"), ("�", None, None)]


def test_listing_year_and_coverage(spark, folder):
    for name in ("x_2007.csv", "a_2008.csv", "b_2008.csv", "n.txt", "2009_2010.ZIP"):
        open(f"{folder}/{name}", "w").write("a\n1\n")
    listing = list_files(spark, folder)
    assert [os.path.basename(p) for p in year_paths(listing, 2007, 2008, r"\.csv$")] == ["x_2007.csv", "a_2008.csv"]
    with pytest.raises(FileNotFoundError, match="2009"):
        year_paths(listing, 2007, 2009, r"\.csv$")
    assert [r["year"] for r in archives_for_years(listing, 2010, 2012).collect()] == [2010]
    assert list_files(spark, f"{folder}/absent").count() == 0


def test_transfer_modes(spark):
    schema = "file_name string, size bigint, modified timestamp"
    remote = spark.sql("SELECT * FROM VALUES ('new', 1L, TIMESTAMP'2024-01-02'), ('same', 1L, TIMESTAMP'2024-01-02'), ('late', 1L, TIMESTAMP'2024-01-03'), ('big', 2L, TIMESTAMP'2024-01-01'), ('unknown', NULL, NULL) AS t(file_name, size, modified)")
    local = spark.sql("SELECT * FROM VALUES ('same', 1L, TIMESTAMP'2024-01-02'), ('late', 1L, TIMESTAMP'2024-01-02'), ('big', 1L, TIMESTAMP'2024-01-02'), ('unknown', 1L, TIMESTAMP'2024-01-02') AS t(file_name, size, modified)")
    wanted = {"skip": {"new"}, "if_newer": {"new", "late"}, "if_size_diff": {"new", "big"}, "always": {"new", "same", "late", "big", "unknown"}}
    for mode, names in wanted.items():
        out = transfer_plan(remote, local, mode).filter("need_transfer").collect()
        assert {r["file_name"] for r in out} == names
    assert schema.startswith("file_name")
    with pytest.raises(ValueError, match="unknown mode"):
        transfer_plan(remote, local, "never")


def test_pending(spark):
    listing = spark.createDataFrame([("a",), ("b",)], "source string")
    written = spark.createDataFrame([("a",), ("a",)], "source string")
    assert [r["source"] for r in pending_sources(listing, written).collect()] == ["b"]
    assert pending_sources(listing, written, replace=True).count() == 2


def test_lender_files(spark, folder):
    for year in (2018, 2019):
        spark.createDataFrame([(str(year), "L1", "P")], "activity_year string, lei string, name string").coalesce(1).write.parquet(f"{folder}/tmp_{year}")
        for kind in ("panel", "ts"):
            os.makedirs(f"{folder}/{kind}", exist_ok=True)
            part = next(f for f in os.listdir(f"{folder}/tmp_{year}") if f.endswith(".parquet"))
            with open(f"{folder}/tmp_{year}/{part}", "rb") as source:
                open(f"{folder}/{kind}/{year}_{kind}.parquet", "wb").write(source.read())
    out = lender_plan.combine_post2018(spark, f"{folder}/panel", f"{folder}/ts", folder, 2018, 2019)
    assert out.columns == ["activity_year", "lei", "name_panel", "name_ts"] and out.count() == 2
    text = spark.read.option("header", True).option("sep", "|").csv(f"{folder}/lenders_combined_2018-2019.csv")
    assert text.count() == 2 and text.columns == out.columns
    assert lender_plan.summarize_post2018(out)["missing_years"] == [2020, 2021, 2022, 2023, 2024]

    os.makedirs(f"{folder}/old_panel")
    os.makedirs(f"{folder}/old_ts")
    open(f"{folder}/old_panel/2007.csv", "w").write("Activity Year,Respondent Identification Number,Agency Code,Respondent Name (Panel)\n2007,1,9, A \n2007,2,9,B\n")
    open(f"{folder}/old_ts/2007.csv", "w").write("Activity Year , Respondent ID,Agency Code,Respondent Name (Panel),Respondent Name\n2007,1,9,x,  \n")
    old = lender_plan.combine_2007_2017(spark, f"{folder}/old_panel", f"{folder}/old_ts", folder, 2007, 2007)
    rows = {tuple(r) for r in old.collect()}
    assert old.columns == ["Activity Year", "Agency Code", "Respondent ID", "Respondent Name Panel", "Respondent Name TS"]
    assert rows == {("2007", "9", "1", "A", None), ("2007", "9", "2", "B", None)}


def test_silver_scan_with_a_canonical_schema(spark, folder):
    spark.sql("SELECT 1 AS assets, 'x' AS lei").write.parquet(f"{folder}/t/activity_year=2018/file_type=a")
    spark.sql("SELECT 2L AS assets, 'y' AS lei, 3L AS lar_count, 'z' AS more").write.parquet(f"{folder}/t/activity_year=2019/file_type=c")
    names = ["lei", "assets", "lar_count", "activity_year", "file_type"]
    df = read_silver(spark, f"{folder}/t", POST2018, names)
    assert {tuple(r) for r in df.select(*names).collect()} == {("x", 1, None, 2018, "a"), ("y", 2, 3, 2019, "c")}


def test_long_headers_and_tables_of_archives(folder):
    import io

    from lendframe.sources import archives

    header = ",".join(f"column_{i}" for i in range(3000)) + "\n"
    assert archives._head(io.BytesIO((header + "1\n").encode())).startswith(header)
    assert archives._tables(["docs/x.csv", "a.csv", "b.txt", "c.pdf"], 2018, False) == ["a.csv", "b.txt"]
    assert archives._tables(["p_2018.txt", "p_2019.TXT", "2018.csv"], 2018, True) == ["p_2018.txt"]
    with pytest.raises(ValueError, match="name the file system"):
        archives._filesystem("/plain/path")


def late_row(text):
    """A file of 2019 with one row of 2018."""
    return text + text.splitlines()[1].replace("2019,", "2018,", 1) + "\n"


def test_partial_import_keeps_rows_of_other_sources(spark, folder):
    put_zip(folder, "loans", "2018_public_lar_csv.zip", {"a.csv": lar_text(2018, 50, ",")})
    put_zip(folder, "loans", "2019_public_lar_csv.zip", {"b.csv": late_row(lar_text(2019, 20, ","))})
    layout = Layout(folder)
    build_bronze(spark, layout, POST2018, "loans")
    path = layout.silver("loans", "post2018")
    assert build_silver(spark, layout, POST2018, "loans")
    full = {tuple(r) for r in read_silver(spark, path, POST2018).collect()}
    assert build_silver(spark, layout, POST2018, "loans", first=2019, last=2019)
    assert {tuple(r) for r in read_silver(spark, path, POST2018).collect()} == full
    assert read_silver(spark, path, POST2018).filter("activity_year = 2018").count() == 51


def test_batch_and_stream_share_one_table(spark, post2018, folder):
    path, twin = post2018.silver("loans", "post2018"), Layout(f"{folder}/twin")

    def same_as_full_import():
        os.makedirs(f"{folder}/twin", exist_ok=True)
        if not os.path.islink(f"{folder}/twin/bronze"):
            os.symlink(f"{folder}/bronze", f"{folder}/twin/bronze")
        build_silver(spark, twin, POST2018, "loans", replace=True)
        spark.catalog.refreshByPath(path)
        # older files lack a later column: read both by one list of columns
        names = ["HMDAIndex", "lei", "county_code", "loan_amount", "income", "loan_type", "activity_year", "file_type"]
        tables = (read_silver(spark, p, POST2018, names) for p in (path, twin.silver("loans", "post2018")))
        have, want = (sorted(map(repr, t.collect())) for t in tables)
        assert have == want
        return len(have)

    def stream():
        refresh_silver(spark, post2018, POST2018, "loans", f"{folder}/ledger").awaitTermination()

    build_bronze(spark, post2018, POST2018, "loans", 2018, 2018)
    build_silver(spark, post2018, POST2018, "loans")
    for _ in range(2):
        stream()
        assert same_as_full_import() == 70
    build_bronze(spark, post2018, POST2018, "loans", 2019, 2019)
    stream()
    assert same_as_full_import() == 90
    put_zip(folder, "loans", "2019_public_lar_csv.zip", {"2019_lar.csv": lar_text(2019, 7, ",")})
    build_bronze(spark, post2018, POST2018, "loans", 2019, 2019, replace=True)
    stream()
    assert same_as_full_import() == 77
    assert build_silver(spark, post2018, POST2018, "loans")
    assert same_as_full_import() == 77


def test_header_columns():
    assert bronze_plan.header_columns('a,"b,c",d', ",") == ["a", "b,c", "d"]


# --- sources that change ------------------------------------------------------

SILVER = ["lei", "loan_amount", "activity_year", "file_type"]


def put_bronze(spark, layout, sources):
    """Bronze sources from {source: [(year, type, amount)]}."""
    rows = [(str(y), k, "L", str(a), s) for s, held in sources.items() for y, k, a in held]
    df = spark.createDataFrame(rows, "activity_year string, file_type string, lei string, loan_amount string, source string")
    write_partitioned(df, layout.bronze("loans", "post2018"), ["source"])


def silver_rows(spark, layout):
    path = layout.silver("loans", "post2018")
    spark.catalog.refreshByPath(path)
    return sorted((r.loan_amount, r.activity_year, r.file_type) for r in read_silver(spark, path, POST2018, SILVER).collect())


def fresh_import(spark, layout, folder):
    """What a first import of the same bronze gives."""
    twin = Layout(os.path.join(folder, f"twin{len(os.listdir(folder))}"))
    os.makedirs(twin.root)
    os.symlink(os.path.join(layout.root, "bronze"), os.path.join(twin.root, "bronze"))
    assert build_silver(spark, twin, POST2018, "loans")
    return silver_rows(spark, twin)


@pytest.fixture()
def changing(spark, folder):
    layout = Layout(os.path.join(folder, "own"))
    put_bronze(spark, layout, {
        "2018_a": [(2018, "a", 1), (2018, "a", 2)],
        "2018_b": [(2018, "b", 3)],
        "2019_c": [(2019, "c", 4), (2019, "c", 5), (2019, "c", 6), (2018, "b", 7), (2018, "b", 8), (2018, "x", 9)],
        "2020_c": [(2020, "c", 10), (None, "c", 11), (2020, None, 12)],
    })
    assert build_silver(spark, layout, POST2018, "loans")
    assert len(silver_rows(spark, layout)) == 12
    return layout


@pytest.mark.parametrize("years", [{"first": 2019, "last": 2019}, {}])
@pytest.mark.parametrize("replace", [False, True])
def test_replaced_source_leaves_no_old_rows(spark, changing, folder, years, replace):
    put_bronze(spark, changing, {"2019_c": [(2019, "c", 4), (2019, "c", 5), (2019, "c", 6)]})
    assert build_silver(spark, changing, POST2018, "loans", replace=replace, **years)
    found = silver_rows(spark, changing)
    assert [a for a, *_ in found] == [1, 2, 3, 4, 5, 6, 10, 11, 12]
    assert found == fresh_import(spark, changing, folder)


@pytest.mark.parametrize("years", [{"first": 2019, "last": 2019}, {}])
def test_removed_source_leaves_no_rows(spark, changing, folder, years):
    drop_source(spark, changing.bronze("loans", "post2018"), "2019_c")
    assert build_silver(spark, changing, POST2018, "loans", **years)
    assert [a for a, *_ in silver_rows(spark, changing)] == [1, 2, 3, 10, 11, 12]
    assert silver_rows(spark, changing) == fresh_import(spark, changing, folder)
    assert not os.path.exists(f"{changing.silver('loans', 'post2018')}/activity_year=2019")
    written = read_ledger(spark, changing.ledger("loans", "post2018"), POST2018, WRITTEN)
    assert {r.source for r in written.collect()} == {"2018_a", "2018_b", "2020_c"}
    assert not build_silver(spark, changing, POST2018, "loans", first=2019, last=2019)


def test_new_rows_in_a_source_that_is_not_imported_wait(spark, changing, folder):
    put_bronze(spark, changing, {"2018_b": [(2018, "b", 3), (2020, "c", 20)]})
    assert build_silver(spark, changing, POST2018, "loans", first=2020, last=2020)
    assert [a for a, y, k in silver_rows(spark, changing) if (y, k) == (2020, "c")] == [10, 20]
    assert build_silver(spark, changing, POST2018, "loans", first=2018, last=2018)
    assert silver_rows(spark, changing) == fresh_import(spark, changing, folder)


def test_partitions_no_import_recorded_go_with_a_whole_replace(spark, changing, folder):
    stray = f"{changing.silver('loans', 'post2018')}/activity_year=2023/file_type=q"
    spark.sql("SELECT 99L AS loan_amount").write.parquet(stray)
    build_silver(spark, changing, POST2018, "loans", first=2018, last=2018, replace=True)
    assert os.path.exists(stray)
    build_silver(spark, changing, POST2018, "loans", replace=True)
    assert not os.path.exists(stray)
    assert silver_rows(spark, changing) == fresh_import(spark, changing, folder)


def test_one_import_reads_only_sources_that_share_its_partitions(spark, changing, monkeypatch):
    plans = []
    plain = silver_plan.write_partitioned

    def kept(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        plain(df, *rest)

    monkeypatch.setattr(silver_plan, "write_partitioned", kept)
    assert build_silver(spark, changing, POST2018, "loans", first=2018, last=2018)
    assert build_silver(spark, changing, POST2018, "loans", first=2020, last=2020)
    pruned = ["PartitionFilters" in line and line for p in plans for line in p.split("\n") if "FileScan" in line]
    assert len(pruned) == 2 and "2018_a" in pruned[0] and "2019_c" in pruned[0] and "2020_c" not in pruned[0]
    assert "2020_c" in pruned[1] and "2018_a" not in pruned[1] and "2019_c" not in pruned[1]


def test_stream_clears_removed_sources(spark, changing, folder):
    def stream():
        refresh_silver(spark, changing, POST2018, "loans", f"{folder}/checkpoint").awaitTermination()

    stream()
    drop_source(spark, changing.bronze("loans", "post2018"), "2019_c")
    stream()
    assert silver_rows(spark, changing) == fresh_import(spark, changing, folder)
    put_bronze(spark, changing, {"2021_a": [(2021, "a", 30), (2018, "x", 31)]})
    stream()
    assert silver_rows(spark, changing) == fresh_import(spark, changing, folder)


# --- lines and archives -------------------------------------------------------


def test_long_lines_fail_are_reported_or_cut(spark, folder):
    text = lar_text(2018, 6, ",").splitlines()
    text[2] += ',9,"a, b"'
    text[4] = ",".join(text[4].split(",")[:-3])
    put_zip(folder, "loans", "2018_public_lar_csv.zip", {"lar.csv": "\n".join(text) + "\n"})
    layout = Layout(folder)
    with pytest.raises(Exception, match="11 fields instead of 9"):
        build_bronze(spark, layout, POST2018, "loans")
    assert written_partitions(spark, layout.bronze("loans", "post2018")).isEmpty()
    for treatment in ("report", "lossy"):
        assert build_bronze(spark, layout, POST2018, "loans", replace=True, long_lines=treatment) == 1
        bronze = read_bronze(spark, layout.bronze("loans", "post2018"))
        assert bronze.count() == 6 and "_rescued_line" not in bronze.columns
        assert bronze.filter("loan_to_value_ratio is null").count() == 1
    rescued = spark.read.parquet(layout.rescued("loans", "post2018")).collect()
    assert [(r.kind, r.fields, r.expected, r.line, r.source) for r in rescued] == [("long", 11, 9, text[2], "2018_public_lar")]
    with pytest.raises(ValueError, match="unknown treatment"):
        build_bronze(spark, layout, POST2018, "loans", long_lines="drop")


def test_every_table_of_an_archive_becomes_a_source(spark, folder):
    put_zip(folder, "loans", "2018_public_lar_csv.zip", {"east.csv": lar_text(2018, 4, ","), "west.txt": lar_text(2018, 3, "|"), "docs/x.csv": "no"})
    put_zip(folder, "loans", "2019_public_lar_csv.zip", {"all.csv": lar_text(2019, 2, ",")})
    layout = Layout(folder)
    assert build_bronze(spark, layout, POST2018, "loans") == 3
    counts = read_bronze(spark, layout.bronze("loans", "post2018")).groupBy("source").count().collect()
    assert {tuple(r) for r in counts} == {("2018_public_lar__east", 4), ("2018_public_lar__west", 3), ("2019_public_lar", 2)}
    assert build_bronze(spark, layout, POST2018, "loans") == 0
    put_zip(folder, "loans", "2018_public_lar_csv.zip", {"east.csv": lar_text(2018, 4, ",")})
    assert build_bronze(spark, layout, POST2018, "loans", replace=True) == 2
    left = written_partitions(spark, layout.bronze("loans", "post2018")).collect()
    assert {r.source for r in left} == {"2018_public_lar", "2019_public_lar"}


def test_tables_alike_are_refused(spark, folder):
    put_zip(folder, "loans", "2018_public_lar_csv.zip", {"a b.csv": lar_text(2018, 1, ","), "a_b.csv": lar_text(2018, 1, ",")})
    with pytest.raises(ValueError, match="one source"):
        build_bronze(spark, Layout(folder), POST2018, "loans")


def test_tract_rows_are_merged_by_year(spark, folder):
    def loans(rows):
        return spark.createDataFrame([(*r, 1) for r in rows], "activity_year string, census_tract string, tract_population string, loan int")

    path = f"{folder}/tracts"
    first = merge_tracts(loans([("2018", "1", "5"), ("2018", "1", "5"), ("2019", "2", None)]), path)
    assert first.count() == 2
    before = set(os.listdir(f"{path}/activity_year=2019"))
    again = merge_tracts(loans([("2018", "1", "5"), ("2018", "3", "7"), ("2019", "2", None), (None, "4", "x")]), path)
    assert {tuple(r) for r in again.collect()} == {("2018", "1", 5.0), ("2019", "2", None), ("2018", "3", 7.0), (None, "4", None)}
    assert set(os.listdir(f"{path}/activity_year=2019")) == before


def test_checkpoint_folder_is_shared_off_a_local_master(spark, monkeypatch):
    """The session names the folder as shared, whatever its scheme; other local paths stay refused."""
    inside = f"{shared_folder(spark)}/layout"
    here = shared_uri(spark, inside)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://far:7077")
    assert shared_uri(spark, inside) == here
    for path in ("/tmp/elsewhere", f"{shared_folder(spark)}-beside/layout", f"{shared_folder(spark)}/../beside"):
        with pytest.raises(ValueError, match="local disk"):
            shared_uri(spark, path)
    assert layer_queries.archive_members(spark, "/root/testdata/sf0.001").count() > 0
    assert layer_queries.tract_dimension_rows(spark, "/root/testdata/sf0.001").count() > 0


def test_archives_are_written_as_a_stream(spark, folder):
    """Rows of a member come in several batches; positions tell the order, not the rows' own."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [("a.zip" if k % 3 else "b.zip", f"m{k % 2}.csv" if k != 9 else None, "x,y", f"{k},é", k) for k in reversed(range(20))]
    table = spark.createDataFrame(rows, "archive_name string, member string, header string, line string, src_pos long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        layer_queries.put_archives(table, f"file://{folder}/raw")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(os.listdir(f"{folder}/raw")) == ["a.zip", "b.zip"]
    for name in ("a.zip", "b.zip"):
        with zipfile.ZipFile(f"{folder}/raw/{name}") as archive:
            assert archive.testzip() is None and sorted(archive.namelist()) == ["docs/readme.txt", "m0.csv", "m1.csv"]
            for member in ("m0.csv", "m1.csv"):
                own = sorted(r[4:] + r[3:4] for r in rows if r[0] == name and r[1] == member)
                assert archive.read(member).decode() == "\n".join(["x,y", *(line for _, line in own)]) + "\n"
                assert archive.getinfo(member).flag_bits & 8  # its size was not known when it began


def test_the_plan_of_an_import_does_not_grow_with_its_tables(spark, folder, monkeypatch):
    plans = []

    def write(df, *rest):
        plans.append(df._jdf.queryExecution().logical().toString())
        return write_partitioned(df, *rest)

    monkeypatch.setattr(bronze_plan, "write_partitioned", write)
    for part in range(3):
        put_zip(folder, "loans", f"2018_public_lar_one_year_p{part}_csv.zip", {"lar.csv": lar_text(2018, 4, ",")})
    put_zip(folder, "loans", "2019_public_lar_three_year_csv.zip", {"lar.csv": lar_text(2019, 2, ",")})
    layout = Layout(folder)
    assert build_bronze(spark, layout, POST2018, "loans") == 4
    assert len(plans) == 1 and "2018_public_lar" not in plans[0]
    found = {(r["source"], r["file_type"], r["HMDAIndex"]) for r in read_bronze(spark, layout.bronze("loans", "post2018")).collect()}
    wanted = {(f"2018_public_lar_one_year_p{p}", "b", f"2018b_{k:09d}") for p in range(3) for k in range(4)}
    assert found == wanted | {("2019_public_lar_three_year", "a", f"2019a_{k:09d}") for k in range(2)}
