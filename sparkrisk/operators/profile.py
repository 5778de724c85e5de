"""Table profiles.

Every statistic is a partial aggregate: computed per task, combined map-side, then merged.
Nothing collects a column into one task; percentiles are exact, by counting passes that narrow the
place of a rank.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERCENTILES = (0.25, 0.5, 0.75)
# Accuracy of the sketches that narrow a percentile: ranks are off by at most 1 / SKETCH.
SKETCH = 5000


def row_count(df: DataFrame) -> DataFrame:
    """A3: one row (rows, is_empty)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("is_empty", F.col("rows") == 0)


def shape(df: DataFrame) -> DataFrame:
    """A4: one row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A5: (value, count), nulls excluded, most frequent first then by value."""
    out = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count()
    return out.orderBy(F.col("count").desc(), F.col("value"))


def _stack(df_one_row: DataFrame, names: Sequence[str], fields: Sequence[str], prefix: str) -> DataFrame:
    """Turn one wide row of per-column stats into one row per column."""
    structs = [
        F.struct(F.lit(n).alias("feature"), *[F.col(f"{prefix}{i}_{f}").alias(f) for f in fields])
        for i, n in enumerate(names)
    ]
    return df_one_row.select(F.inline(F.array(*structs)))


def profile(df: DataFrame) -> DataFrame:
    """Per column: distinct non-null values, type, missing count and share, sorted by
    missing descending.

    One scan. Each row becomes (column, value as text) pairs, grouped by pair with a map-side
    partial aggregate; per column, the null group gives the missing count, the other groups the
    distinct count, and all groups the row count. Values are told apart by their text.
    """
    names = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    type_of = F.create_map(*[x for c in names for x in (F.lit(c), F.lit(types[c]))])
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in names]))
    )
    groups = pairs.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))
    per = groups.groupBy("feature").agg(
        F.count("value").alias("classes"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("missing"),
        F.sum("rows").alias("n"),
    )
    out = per.select(
        "feature",
        F.col("classes").cast("bigint").alias("classes"),
        type_of[F.col("feature")].alias("datatype"),
        F.col("missing").cast("bigint").alias("missing"),
        (F.col("missing") / F.col("n")).alias("missing_percent"),
    )
    return out.orderBy(F.col("missing").desc(), F.col("feature"))


def _is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def exact_percentiles(df: DataFrame, shares: Mapping[str, Sequence[float]]) -> dict[tuple[str, float], float | None]:
    """The smallest value of each column that reaches each share of its values (nulls and NaN are
    none).

    Selection by narrowing: a sketch gives two values between which the wanted rank must lie, the
    next pass counts what is below and between them and sketches only the values between, and so on
    until both are one value. A pass is one aggregation for all columns and shares, whose result is
    one row; each one leaves about 1 / 2500 of the values, so a trillion rows take five. Nothing is
    sorted, shuffled by value or written.
    """
    wanted = [(c, p) for c, ps in shares.items() for p in ps]
    x = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in shares}
    first = df.agg(*[e for i, c in enumerate(shares) for e in (
        F.count(x[c]).alias(f"n{i}"), F.min(x[c]).alias(f"a{i}"), F.max(x[c]).alias(f"b{i}"))]).first()
    out: dict[tuple[str, float], float | None] = {}
    n, spans = {}, {}  # (column, share) -> (low, high): the value is one of those between
    for i, c in enumerate(shares):
        n[c] = first[f"n{i}"]
        for p in shares[c]:
            spans[c, p] = (first[f"a{i}"], first[f"b{i}"])
    rank = {(c, p): max(1, math.ceil(p * n[c])) for c, p in wanted}
    below = {w: 0 for w in wanted}  # values under the span
    within = {w: n[w[0]] for w in wanted}
    while True:
        for w in [w for w in spans if spans[w][0] == spans[w][1] or not within[w]]:
            out[w] = spans.pop(w)[0]
        if not spans:
            return out
        # Where the wanted rank may be among the values of the span, as shares of them.
        near = {}
        for w in spans:
            at = (rank[w] - below[w]) / within[w]
            near[w] = (max(0.0, at - 2 / SKETCH), min(1.0, at + 2 / SKETCH))
        order = list(spans)
        got = df.agg(*[F.percentile_approx(F.when(x[w[0]].between(*map(F.lit, spans[w])), x[w[0]]), list(near[w]), SKETCH).alias(f"s{i}")
                       for i, w in enumerate(order)]).first()
        tries = {w: tuple(got[f"s{i}"]) for i, w in enumerate(order)}
        counted = df.agg(*[e for i, w in enumerate(order) for e in (
            F.count_if(x[w[0]] < tries[w][0]).alias(f"l{i}"), F.count_if(x[w[0]] < tries[w][1]).alias(f"m{i}"),
            F.count_if(x[w[0]] <= tries[w][1]).alias(f"u{i}"), F.count_if(x[w[0]] <= tries[w][0]).alias(f"e{i}"),
            *_ends(x[w[0]], *tries[w], i))]).first()
        for i, w in enumerate(order):
            (low, high), (a, b), k = spans[w], tries[w], rank[w]
            lower, middle, upper, equal = (counted[f"{f}{i}"] for f in "lmue")
            if lower < k <= equal:
                high, low = a, a
            elif middle < k <= upper:
                high, low = b, b
            elif equal < k <= middle:  # strictly between, and both ends are taken off by counting
                spans[w], below[w], within[w] = (counted[f"first{i}"], counted[f"last{i}"]), equal, middle - equal
                continue
            elif k <= lower:  # the sketch missed: the part below it
                r = df.agg(*_ends(x[w[0]], low, a, 0, least=low)).first()
                spans[w], within[w] = (r["first0"], r["last0"]), lower - below[w]
                continue
            else:
                r = df.agg(*_ends(x[w[0]], b, high, 0, most=high)).first()
                spans[w], below[w], within[w] = (r["first0"], r["last0"]), upper, within[w] - (upper - below[w])
                continue
            spans[w] = (low, high)


def _ends(x: Column, a: float, b: float, i: int, least: float | None = None, most: float | None = None) -> list[Column]:
    """Least and largest value strictly between ``a`` and ``b``; from ``least`` or up to ``most`` if given."""
    inside = ((x > a) if least is None else (x >= least)) & ((x < b) if most is None else (x <= most))
    return [F.min(F.when(inside, x)).alias(f"first{i}"), F.max(F.when(inside, x)).alias(f"last{i}")]


def describe_all(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Per column: count and unique; for other than numeric columns ``top`` (the most
    frequent non-null value as text, ties broken by the smaller text) and ``freq``; for
    numeric columns mean, std, min, 25/50/75 % and max. Percentiles are the smallest value
    reaching the share, exact at any size. ``digits`` rounds mean and std.

    One aggregation for counts and moments, one long form (column, value as text) counted by value
    for distinct counts and most frequent values, and the passes of ``exact_percentiles``. ``df`` is
    read several times: give it a table, not a long computation. Distinct values are told apart by
    their text (so -0.0 and 0.0 count twice).
    """
    fields = df.schema.fields
    numeric = [f.name for f in fields if _is_numeric(f.dataType)]
    found = exact_percentiles(df, {c: PERCENTILES for c in numeric}) if numeric else {}
    aggs = []
    for i, f in enumerate(fields):
        c, is_num = F.col(f"`{f.name}`"), f.name in numeric
        x = c.cast("double") if is_num else F.lit(None).cast("double")
        stats = {"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        if digits is not None:
            stats |= {k: F.round(stats[k], digits) for k in ("mean", "std")}
        stats |= {f"p{int(100 * p)}": F.lit(found.get((f.name, p))).cast("double") for p in PERCENTILES}
        aggs += [F.count(c).alias(f"d{i}_count"), *[v.alias(f"d{i}_{k}") for k, v in stats.items()]]
    names = ["count", "mean", "std", "min", "max", *[f"p{int(100 * p)}" for p in PERCENTILES]]
    stats = _stack(df.agg(*aggs), [f.name for f in fields], names, "d")
    pairs = [F.struct(F.lit(f.name).alias("feature"), F.col(f"`{f.name}`").cast("string").alias("value")) for f in fields]
    long = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    best = F.min_by(F.struct("value", "count"), F.struct((-F.col("count")).alias("k"), F.col("value")))
    is_num = F.col("feature").isin(*numeric) if numeric else F.lit(False)
    per = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("unique"), best.alias("t"))
    per = per.select("feature", "unique", F.when(~is_num, F.col("t.value")).alias("top"), F.when(~is_num, F.col("t.count")).alias("freq"))
    # One row per column on either side: as many as the schema has.
    out = stats.join(F.broadcast(per), "feature", "left").withColumn("unique", F.coalesce(F.col("unique"), F.lit(0)).cast("bigint"))
    return out.select("feature", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for every ordered pair (a, b) of numeric columns, using the
    rows where both are non-null; rounded to ``digits``."""
    # Correlation is symmetric: each unordered pair is computed once and listed in both orders.
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    one = df.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"c{i}_{j}") for i, j in pairs])
    structs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"c{max(i, j)}_{min(i, j)}"), digits).alias("r"))
               for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return one.select(F.inline(F.array(*structs)))
