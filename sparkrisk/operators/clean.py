"""Projections, filters and cleaning.

Every step is a narrow transformation: no shuffle, and Catalyst collapses the chain into
one projection over the scan, with the filters pushed into the parquet reader.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import scalar as S
from sparkrisk.schemas import DEFAULT_CITY, DEFAULT_ZIP

# The level code excluded from the history and the blank status.
EXCLUDED_LEVEL = "1919"
BLANK_STATUS = " "
# The city alias fixed at scoring time.
CITY_ALIAS = ("downtownfinancial", "financial")


def clean_events(
    df: DataFrame,
    key: str = "property_id",
    level: str = "viollevel",
    status: str = "violstatus",
    excluded_level: str = EXCLUDED_LEVEL,
    blank_status: str = BLANK_STATUS,
) -> DataFrame:
    """``level != excluded AND key IS NOT NULL AND status != blank``.

    SQL null logic: a null level or status makes the predicate null, so the row is
    dropped; an empty string is kept.
    """
    return df.filter(
        (F.col(level) != F.lit(excluded_level))
        & F.col(key).isNotNull()
        & (F.col(status) != F.lit(blank_status))
    )


def select_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P2."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Case-insensitive; absent names are a no-op."""
    lower = {c.lower(): c for c in df.columns}
    actual = {lower[k.lower()]: v for k, v in mapping.items() if k.lower() in lower}
    return df.withColumnsRenamed(actual) if actual else df


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """P5."""
    return df.withColumns({c: S.default_if_null(c, v) for c, v in defaults.items()})


def default_blanks(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """P6."""
    return df.withColumns({c: S.default_if_blank(c, v) for c, v in defaults.items()})


def label(df: DataFrame, source: str = "viol_fail", out: str = "fail") -> DataFrame:
    """1 when ``source > 0`` else 0; null gives 0."""
    return df.withColumn(out, F.when(F.col(source) > 0, F.lit(1)).otherwise(F.lit(0)))


def to_int(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Integer casts; text that is not a number gives null (ANSI-safe)."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in cols})


def fill_numeric(df: DataFrame, value, subset: Iterable[str] | None = None) -> DataFrame:
    """Fill nulls of numeric columns (strings and timestamps are left alone)."""
    return df.fillna(value, subset=list(subset) if subset is not None else None)


def split_by_type(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P10: (categorical columns, numeric columns) by the schema."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    cat = [f.name for f in df.schema.fields if f.name not in num]
    return df.select(*cat), df.select(*num)


def features_and_target(df: DataFrame, target: str = "fail") -> tuple[DataFrame, DataFrame]:
    """P11."""
    return df.drop(target), df.select(target)


def clean_city(
    df: DataFrame,
    stage: str = "train",
    city: str = "city",
    zip_col: str = "zip",
    default_city: str = DEFAULT_CITY,
    default_zip: str = DEFAULT_ZIP,
    lower_cols: Iterable[str] = (),
) -> DataFrame:
    """Normalise city and zip.

    ``train``: lower, null city to the default, remove '/', two spaces to one, null zip to
    the default. ``score``: null zip to the default, lower, remove '/', alias fix, two
    spaces to one, '' and ' ' to the default city (a null city stays null).
    """
    c = F.col(city)
    if stage == "train":
        c = S.collapse_double_spaces(S.remove_slashes(F.coalesce(F.lower(c), F.lit(default_city))))
    elif stage == "score":
        c = S.remove_slashes(F.lower(c))
        c = S.collapse_double_spaces(S.replace_text(c, *CITY_ALIAS))
        c = S.default_if_blank(c, default_city)
    else:
        raise ValueError(f"unknown stage {stage!r}")
    cols = {city: c, zip_col: S.default_if_null(zip_col, default_zip)}
    cols.update({x: F.lower(F.col(x)) for x in lower_cols})
    return df.withColumns(cols)
