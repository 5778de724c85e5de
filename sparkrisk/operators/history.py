"""Event history and latest state per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import scalar as S
from sparkrisk.operators import clean as C
from sparkrisk.operators.sequence import latest, ordered_window
from sparkrisk.schemas import FIRST_EVENT_FILL

# The history's entity key, event time, tie-break order and outcome values.
KEY = "property_id"
TIME = "resultdttm"
TIES = ("issdttm", "state", "location", "licensecat", "descript", "city", "zip")
STATUS = "violstatus"
OUTCOMES = {"viol_fail": "Fail", "viol_pass": "Pass"}
# Renames applied to entity records before scoring.
ENTITY_RENAMES = {
    "Property_ID": "property_id",
    "LICENSECAT": "licensecat",
    "DESCRIPT": "descript",
    "CITY": "city",
    "ZIP": "zip",
}


def pivot_count(
    df: DataFrame, keys: Sequence[str], col: str, values: Mapping[str, str | None] | Sequence[str]
) -> DataFrame:
    """A1/A2: rows per group, one column per value of ``col``; null where a group has no
    row with that value. Values are compared case-sensitively.

    ``values`` is a list (columns named by the values) or ``{column: value}``; the value None counts
    the nulls. Written as
    conditional counts in a single aggregation: no job to discover values, one shuffle of
    map-side combined partial counts, and only the listed values become columns.
    """
    named = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    aggs = [
        F.nullif(F.count_if(F.col(col).isNull() if v is None else F.col(col) == F.lit(v)), F.lit(0)).alias(name)
        for name, v in named.items()
    ]
    return df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()


def pivot_values(df: DataFrame, col: str, most: int = 1000, null_name: str = "null", blank_name: str = "blank") -> dict[str, str | None]:
    """The values of ``col`` as ``{column: value}``, by value, for ``pivot_count``: null becomes the
    column ``null_name``, '' the column ``blank_name``. More than ``most`` values are an error (no value
    is left out without notice), and so are two values whose columns would have one name."""
    found = df.select(F.col(col).cast("string").alias("v")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} values; list those to pivot")
    names: dict[str, str | None] = {}
    lower: dict[str, str | None] = {}
    for v in sorted((r.v for r in found), key=lambda v: (v is not None, v or "")):
        name = null_name if v is None else blank_name if v == "" else v
        if name.lower() in lower:
            raise ValueError(f"{col}: {v!r} and {lower[name.lower()]!r} both give the column {name}")
        lower[name.lower()] = v
        names[name] = v
    return names


def pivot_all(df: DataFrame, keys: Sequence[str], col: str, most: int = 1000, null_name: str = "null",
              blank_name: str = "blank") -> DataFrame:
    """A2 without a list of values: a first pass finds them (``pivot_values``; distinct values only
    leave the tasks), the second counts. A value named like a key is an error."""
    values = pivot_values(df, col, most, null_name, blank_name)
    clash = {k.lower() for k in keys} & {n.lower() for n in values}
    if clash:
        raise ValueError(f"values of {col} are named like keys: {sorted(clash)}")
    return pivot_count(df, keys, col, values)


def attach_counts(hist: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer join USING ``keys``; a null key never matches."""
    return hist.join(counts, list(keys), "left")


def attach_latest(entities: DataFrame, latest_rows: DataFrame, key: str = KEY) -> DataFrame:
    """Entities keep their rows whether or not they have events."""
    return entities.join(latest_rows, key, "left")


def build_history(
    events: DataFrame,
    key: str = KEY,
    time: str = TIME,
    ties: Sequence[str] = TIES,
    status: str = STATUS,
    outcomes: Mapping[str, str] = OUTCOMES,
    first_fill: int = FIRST_EVENT_FILL,
    strategy: str = "range",
) -> DataFrame:
    """One history row per distinct event tuple (key, time, ties).

    Per row: running ordinal, previous event time, days since it, outcome counts of the
    (key, time) visit, 0/1 label, and the previous row's outcome counts. First events get
    ``first_fill`` for the previous-value columns; a null time matches no counts (0).

    Plan: filter and clean (narrow, pushed into the scan), one aggregation that both removes
    duplicates and counts outcomes per tuple (map-side combined), then one ordered window
    pass that sums the counts per visit and adds ordinal and lags (see ``ordered_window``).
    The visit counts need no join back; a visit that spans ranges is added up from its parts.
    """
    fail_col, pass_col = list(outcomes)[:2]
    cleaned = C.clean_city(C.clean_events(events, key=key, status=status), stage="train", lower_cols=("state",))
    tuple_cols = [key, time, *ties]
    per_tuple = cleaned.groupBy(*tuple_cols).agg(
        *[F.count_if(F.col(status) == F.lit(v)).alias(f"__n_{name}") for name, v in outcomes.items()]
    )
    hist = ordered_window(
        per_tuple,
        key,
        time,
        ties,
        row_number="inspections_so_far",
        lags={"last_inspections": time, "last_" + fail_col: fail_col, "last_" + pass_col: pass_col},
        group_sums={name: f"__n_{name}" for name in outcomes},
        null_time_sum=0,
        strategy=strategy,
    )
    days = F.coalesce(S.days_between(time, "last_inspections"), F.lit(first_fill))
    return hist.select(
        key,
        time,
        *ties,
        F.col("inspections_so_far").cast("int").alias("inspections_so_far"),
        "last_inspections",
        days.alias("days_since_last_inspect"),
        *[F.col(name).cast("bigint").alias(name) for name in outcomes],
        F.when(F.col(fail_col) > 0, F.lit(1)).otherwise(F.lit(0)).alias("fail"),
        *[
            F.coalesce(F.col("last_" + name), F.lit(first_fill).cast("bigint")).alias("last_" + name)
            for name in outcomes
        ],
    )


def latest_state(
    history: DataFrame,
    as_of: str | None = None,
    key: str = KEY,
    time: str = TIME,
    ties: Sequence[str] = TIES,
) -> DataFrame:
    """W5 + F6/F7: per entity, the latest history row's ordinal, days from it to ``as_of``
    and its outcome counts (as the previous counts of the next event)."""
    last = latest(history, key, time, ties, cols=[time, "inspections_so_far", "viol_fail", "viol_pass"])
    return last.select(
        key,
        F.col("inspections_so_far").cast("int").alias("inspections_so_far"),
        S.days_between(S.as_of_date(as_of), F.col(time)).alias("days_since_last_inspect"),
        F.col("viol_fail").cast("int").alias("last_viol_fail"),
        F.col("viol_pass").cast("int").alias("last_viol_pass"),
    )


def latest_features(
    history: DataFrame,
    entities: DataFrame,
    as_of: str | None = None,
    key: str = KEY,
    time: str = TIME,
    ties: Sequence[str] = TIES,
    renames: Mapping[str, str] = ENTITY_RENAMES,
    first_fill: int = FIRST_EVENT_FILL,
) -> DataFrame:
    """Entity rows with the features of their latest history row.

    ``days_since_last_inspect`` counts from ``as_of`` (today when None). Entities without
    history get ``first_fill`` days and 0 for the other features.
    """
    last = latest_state(history, as_of, key, time, ties)
    ents = C.clean_city(C.rename(entities, renames), stage="score")
    data = attach_latest(ents, last, key)
    data = data.fillna(first_fill, subset=["days_since_last_inspect"])
    return data.fillna(0, subset=["inspections_so_far", "last_viol_fail", "last_viol_pass"])
