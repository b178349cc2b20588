"""Codes read from file names, bucket labels and raw text heads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Published bucket labels and their codes.
UNIT_BUCKETS = {"5-24": 5, "25-49": 6, "50-99": 7, "100-149": 8, ">149": 9}
AGE_BUCKETS = {
    "<25": 1, "25-34": 2, "35-44": 3, "45-54": 4, "55-64": 5, "65-74": 6, ">74": 7,
}
AGE62_FLAGS = {
    "No": 0, "no": 0, "NO": 0,
    "Yes": 1, "yes": 1, "YES": 1,
    "Na": None, "na": None, "NA": None,
}
DTI_BUCKETS = {
    "<20%": 10, "20%-<30%": 20, "30%-<36%": 30, "50%-60%": 50, ">60%": 60,
    "Exempt": -99999,
}
CONFORMING_CODES = {"NC": 0, "C": 1, "U": -99999, "NA": -99999}

# File name parts and the type code they stand for, first match wins.
FILE_TYPES_POST2018 = (
    ("three_year", "a"),
    ("one_year", "b"),
    ("public_lar", "c"),
    ("public_panel", "c"),
    ("public_ts", "c"),
    ("mlar", "e"),
)
FILE_TYPES_2007_2017 = (
    ("three_year", "a"),
    ("one_year", "b"),
    ("public_lar", "c"),
    ("nationwide", "d"),
    ("mlar", "e"),
)

# File name patterns and the raw folder they go to, first match wins.
ROUTES = (
    ("msamd", "msamd"),
    ("public_ts|transmiss|(^|[_-])ts([_-]|$)", "transmissal_series"),
    ("public_panel|(^|[_-])panel([_-]|$)", "panel"),
    ("mlar|public_lar|(^|[_-])lar([_-]|$)|nationwide", "loans"),
)
DEFAULT_ROUTE = "misc"

# Delimiters in order of preference.
DELIMITERS = (",", "|", "\t", ";")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _first_match(name: Column, pairs) -> Column:
    case = F
    for part, code in pairs:
        case = case.when(F.contains(name, F.lit(part)), F.lit(code))
    return case


def file_type(path: Column, pairs, strict: bool = True) -> Column:
    """Type code from a file name; unknown names raise unless ``strict`` is off."""
    name = base_name(path)
    case = _first_match(F.lower(name), pairs)
    if not strict:
        return case
    message = F.concat(F.lit("no file type in name: "), name)
    return case.otherwise(F.raise_error(message).cast("string"))


def file_type_post2018(path: Column, strict: bool = True) -> Column:
    """The extension does not count towards the match."""
    return file_type(F.regexp_replace(path, r"\.[^./]*$", ""), FILE_TYPES_POST2018, strict)


def file_type_2007_2017(path: Column, strict: bool = True) -> Column:
    return file_type(path, FILE_TYPES_2007_2017, strict)


def raw_folder(file_name: Column) -> Column:
    """Raw subfolder a file belongs in."""
    name = F.lower(file_name)
    case = F
    for pattern, folder in ROUTES:
        case = case.when(name.rlike(pattern), F.lit(folder))
    return case.otherwise(F.lit(DEFAULT_ROUTE))


def normal_stem(path: Column) -> Column:
    """File name without folder, extension and one trailing ``_csv`` then ``_pipe``."""
    stem = F.regexp_replace(base_name(path), r"\.[^.]*$", "")
    return F.regexp_replace(F.regexp_replace(stem, "_csv$", ""), "_pipe$", "")


def with_delimiter(df: DataFrame, head: str = "head", name: str = "delimiter") -> DataFrame:
    """Delimiter of each row's text head.

    Quoted parts are ignored. Each candidate is scored by the share of lines that
    hold it as often as the header line does; ties go to the candidate the header
    holds more often, then to the order of ``DELIMITERS``. Null if none occurs in
    the header. The last line counts only if the head ends with a line break, or
    has no other line.
    """
    text = F.regexp_replace(F.regexp_replace(F.col(head), '"[^"]*"', ""), "\r", "")
    whole = F.when(F.contains(text, F.lit("\n")), F.regexp_replace(text, "\n[^\n]*$", ""))
    lines = F.filter(F.split(F.coalesce(whole, text), "\n"), lambda line: line != "")

    def counts(mark: str) -> Column:
        def times(line: Column) -> Column:
            return F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))

        return F.transform(F.col("_lines"), times)

    def score(rank: int, mark: str) -> Column:
        found = F.col(f"_counts{rank}")
        header = F.get(found, F.lit(0))
        odd = F.size(F.array_remove(found, header)) / F.size(found)
        parts = ((-odd).alias("share"), header.alias("header"))
        return F.when(header > 0, F.struct(*parts, F.lit(-rank).alias("rank"), F.lit(mark).alias("mark")))

    marks = dict(enumerate(DELIMITERS))
    best = F.array_max(F.array(*[score(i, d) for i, d in marks.items()]))["mark"]
    return (
        df.withColumn("_lines", lines)
        .withColumns({f"_counts{i}": counts(d) for i, d in marks.items()})
        .withColumn(name, best)
        .drop("_lines", *[f"_counts{i}" for i in marks])
    )
