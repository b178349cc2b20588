"""Truth tables of the column expressions."""

import pytest
from pyspark.sql import functions as F

from lendframe.functions import casts, codes
from lendframe.operators import harmonize


def values(spark, items, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    rows = df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def test_to_whole(spark):
    text = ["12", "+5", "-7", "150.0", " 12", "12 ", "1e3", "", "abc", None, "99999999999999999999", "007"]
    want = [12, 5, -7, None, None, None, None, None, None, None, None, 7]
    assert values(spark, text, casts.to_whole) == want


def test_to_double(spark):
    text = ["1.5", "5.", ".5", "-2e3", "1E-2", "5d", "NaN", "inf", "Infinity", " 1", "0x1p3", "", None, "1.2.3"]
    want = [1.5, 5.0, 0.5, -2000.0, 0.01, *[None] * 9]
    assert values(spark, text, casts.to_double) == want


@pytest.mark.parametrize(("rule", "exempt"), [(casts.to_double, None), (harmonize.exempt_or_double, -99999.0)])
def test_decimal_text_is_matched_once(spark, rule, exempt):
    text = ["1.5", "1.5\n", ".5", "1e308", "-1e400", "9" * 400, "Exempt", " Exempt", "NA", "NaN", "", None]
    assert values(spark, text, rule) == [1.5, 1.5, 0.5, 1e308, None, None, exempt, *[None] * 5]
    plan = spark.createDataFrame([("1",)], "v string").select(rule(F.col("v")).alias("out"))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("RLIKE") == 1


def test_zero_pad_never_cuts(spark):
    text = ["5", "-5", "+5", "1234567", "", None, "12345"]
    want = ["00005", "-0005", "+0005", "1234567", "00000", None, "12345"]
    assert values(spark, text, lambda c: casts.zero_pad(c, 5)) == want


def test_code_text(spark):
    text = ["1001.0", "1001", "01001", "11001.9", "123456.0", "-5", "1e3", "NA", None, "+7", "", "12."]
    want = ["01001", "01001", "01001", "11001", "123456", "-0005", "01000", None, None, "00007", None, "00012"]
    assert values(spark, text, lambda c: casts.code_text(c, 5)) == want


def test_whole_code(spark):
    text = ["6", "06", "006", "+6", "6.0", "-6", "", None]
    want = ["06", "06", "06", "06", None, "-6", None, None]
    assert values(spark, text, lambda c: casts.whole_code(c, 2)) == want


def test_round_half_away(spark):
    numbers = [2.5, -2.5, 123456.99999999999, 0.4, None, 1e300]
    assert values(spark, numbers, casts.round_half_away, "double") == [3, -3, 123457, 0, None, None]


def test_strip_takes_all_white_space(spark):
    assert values(spark, ["\t a b\r\n", " x　", None, " "], casts.strip) == ["a b", "x", None, ""]


@pytest.mark.parametrize(
    ("rule", "pairs"),
    [
        (harmonize.units_code, {**codes.UNIT_BUCKETS, "4": 4, "40000": None, "1.0": None}),
        (harmonize.age_code, {**codes.AGE_BUCKETS, "8888": 8888, "9999": 9999, "x": None}),
        (harmonize.age62_code, {**codes.AGE62_FLAGS, "1": 1, "yEs": None}),
        (harmonize.dti_code, {**codes.DTI_BUCKETS, "41": 41, "NA": None, "36%": None}),
        (harmonize.conforming_code, {**codes.CONFORMING_CODES, "3": 3, "c": None}),
        (harmonize.exempt_or_double, {"Exempt": -99999.0, "4.5": 4.5, "exempt": None}),
        (harmonize.exempt_or_whole, {"Exempt": -99999, "360": 360, "360.0": None}),
    ],
)
def test_literal_rules(spark, rule, pairs):
    assert values(spark, list(pairs), rule) == list(pairs.values())
    assert values(spark, [None], rule) == [None]


def test_income_keeps_the_sentinel(spark):
    assert values(spark, [120, -99999, None], harmonize.income_to_dollars, "bigint") == [120_000, -99_999, None]


def test_file_types(spark):
    names = {
        "/x/2018_public_lar_three_year_csv.zip": "a",
        "2018_public_lar_one_year_pipe.zip": "b",
        "2019_PUBLIC_LAR_csv.zip": "c",
        "2019_public_panel_csv.zip": "c",
        "2019_public_ts_csv.zip": "c",
        "2019_mlar_header.zip": "e",
    }
    assert values(spark, list(names), codes.file_type_post2018) == list(names.values())
    assert values(spark, ["2012_nationwide_all.parquet"], codes.file_type_2007_2017) == ["d"]
    with pytest.raises(Exception, match="no file type"):
        values(spark, ["readme.zip"], codes.file_type_post2018)


def test_routes(spark):
    names = {
        "2020_msamd_ts.zip": "msamd",
        "hist_ts_2009.zip": "transmissal_series",
        "transmissal.zip": "transmissal_series",
        "2019_panel_csv.zip": "panel",
        "lar_2004.zip": "loans",
        "2012_nationwide_all.zip": "loans",
        "avery.zip": "misc",
        "charts.zip": "misc",
    }
    assert values(spark, list(names), codes.raw_folder) == list(names.values())


def test_normal_stem(spark):
    text = ["/a/2018_public_lar_csv.zip", "b_pipe.zip", "c_pipe_csv.zip", "d_csv_pipe.zip", "e.v1.zip"]
    assert values(spark, text, codes.normal_stem) == ["2018_public_lar", "b", "c", "d_csv", "e.v1"]


def test_delimiters(spark):
    heads = [
        "a,b\n1,2\n3",
        "a|b,c|d\n1|2|3\n",
        "a\tb\n1\t2",
        'a;b\n"x,y,z";2\n',
        "single\n1\n",
        'n|m\r\n"a|b|c"|2\r\n',
    ]
    df = spark.createDataFrame(list(enumerate(heads)), "i int, head string")
    rows = codes.with_delimiter(df).orderBy("i").collect()
    assert [r["delimiter"] for r in rows] == [",", "|", "\t", ";", None, "|"]
