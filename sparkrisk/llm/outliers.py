"""Robust multivariate outliers among document statistics (operator 3); DataFrame functions only.

Every text gives exact counts (see ``statistics``), from which a vector is formed::

    log(1 + words), log(characters per word), sqrt(symbols per character),
    sqrt(share of words in repeated 3-word windows), log(1 + repeated lines)

For each group (language and source; groups below ``min_group`` rows are pooled per language,
then all together) the minimum covariance determinant is approached from coordinate-wise medians
and absolute deviations by concentration steps: the ``support`` share of rows with the least
Mahalanobis distance gives the next mean and covariance. A fixed small variance is added to the
diagonal, since many statistics are constant in clean text. Distances are scaled so that their
median is that of the chi-squared distribution, and rows beyond ``cutoff`` are rejected.

All steps are partial aggregates per group (moments and quantile sketches), so a group that holds a
third of all rows is combined in the tasks first. Distances use the Cholesky factor in plain
columns. The estimates are joined by broadcast if there are at most ``MAX_BROADCAST_GROUPS``
groups, else by shuffle.

Defined results: a null text has no words; null languages or sources are groups of their own;
a pool with fewer than ``2 * 5 + 1`` rows rejects nothing beyond the base rules; rows with equal
ids are judged each for itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import stage

DIMENSIONS = 5
MIN_GROUP = 200
SUPPORT = 0.75
STEPS = 3
# Quantiles of the chi-squared distribution with 5 degrees of freedom.
CHI2_MEDIAN = 4.351460191
CHI2_CUTOFF = 40.0  # beyond all but two in ten million of normally distributed rows
# Variances added to the diagonal, in the order of the vector.
FLOORS = (0.05**2, 0.05**2, 0.05**2, 0.10**2, 0.35**2)
MAX_BROADCAST_GROUPS = 50_000
_X = [f"x{i}" for i in range(DIMENSIONS)]
_SPACE = " \t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, from the word array."""
    low = (1 << 24) - 1  # window number; the hash of its words above

    def repeated(s: Column) -> Column:
        at = lambda j: F.get(s, j).bitwiseAND(F.lit(low)).cast("int")
        same_words = lambda a, b: (F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1)) & (F.get(w, a + 2) == F.get(w, b + 2))
        pairs = F.filter(F.sequence(F.lit(1), F.size(s) - 1),
                         lambda j: (F.shiftrightunsigned(F.get(s, j).bitwiseXOR(F.get(s, j - 1)), 24) == 0) & same_words(at(j), at(j - 1)))
        starts = F.flatten(F.transform(pairs, lambda j: F.array(at(j), at(j - 1))))
        return F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(starts), lambda p: F.array(p, p + 1, p + 2)))))

    coded = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    return F.when(F.size(w) >= 4, _let(F.array_sort(coded), repeated)).otherwise(0)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(key, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of whole texts."""
    t = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[key].alias(key), docs[lang].cast("string").alias("lang"), docs[source].cast("string").alias("source"), t.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, _SPACE, "")) > 0)
    words = F.filter(F.split("t", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    counted = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).cast("long").alias("r")))
    return rows.select(
        key, "lang", "source", counted.alias("c"), F.length(F.translate("t", _SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    ).select(key, "lang", "source", F.col("c.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("c.r").alias("n_repeat_words"))


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p("n_words"), F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
            F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 1)), F.sqrt(F.col("n_repeat_words") / n), F.log1p("n_dup_lines")]


def _with(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with the columns of their group's estimates (a written table, one row per group)."""
    if estimates.count() <= MAX_BROADCAST_GROUPS:
        return rows.join(F.broadcast(estimates), "grp")
    return rows.join(estimates, "grp")


def _estimates(grouped: DataFrame, cov) -> DataFrame:
    """Mean columns ``m<i>`` and the factor, step by step, so that no expression is repeated."""
    factor, df = {}, grouped
    for i in range(DIMENSIONS):
        for j in range(i + 1):
            rest = cov(i, j) + F.lit(FLOORS[i] if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            factor[f"l{i}{j}"] = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] * 0.5))) if i == j else rest / F.col(f"l{j}{j}")
            df = df.withColumn(f"l{i}{j}", factor[f"l{i}{j}"])
    return stage(df.select("grp", *[f"m{i}" for i in range(DIMENSIONS)], *factor), "estimates")


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i in range(DIMENSIONS):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * y[k]
        y.append(rest / F.col(f"l{i}{i}"))
    total = y[0] * y[0]
    for v in y[1:]:
        total = total + v * v
    return total


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
             min_group: int = MIN_GROUP, support: float = SUPPORT, steps: int = STEPS, cutoff: float = CHI2_CUTOFF) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance)."""
    own = stage(statistics(docs, key, text, lang, source), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # The group of every row: its source if large enough, else its language's rest, else all rest.
    sizes = stage(own.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "groups")
    small = sizes.filter(F.col("n") < min_group).groupBy("lang").agg(F.sum("n").alias("n"))
    kinds = sizes.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), F.col("n").alias("gn")).join(
        small.select(F.col("lang").alias("sl"), F.col("n").alias("sn")), F.col("gl").eqNullSafe(F.col("sl")), "left")
    # Nulls are written out, and a pool's name says that it is one: no two groups share a name.
    name = lambda kind, *cols: F.to_json(F.struct(F.lit(kind).alias("of"), *cols), {"ignoreNullFields": "false"})
    kinds = stage(kinds.select("gl", "gs", F.when(F.col("gn") >= min_group, name("source", "gl", "gs"))
                               .when(F.col("sn") >= min_group, name("language", "gl")).otherwise(F.lit("")).alias("grp")), "kinds")
    kinds = F.broadcast(kinds) if kinds.count() <= MAX_BROADCAST_GROUPS else kinds
    rows = own.join(kinds, F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs")))
    rows = rows.drop("gl", "gs").withColumns(dict(zip(_X, _vector())))
    rows = stage(rows.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "grp", *_X), "vectors")
    vectors = rows.select("grp", *_X)

    # Start: medians, then absolute deviations from them.
    median = stage(vectors.groupBy("grp").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(_X)]), "medians")
    spread = _with(vectors, median).groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIMENSIONS)],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i, x in enumerate(_X)])
    estimates = _estimates(spread, lambda i, j: F.pow(1.4826 * F.col(f"d{i}"), 2) if i == j else F.lit(0.0))
    for _ in range(steps):  # concentration: the closest rows give the next estimate
        near = _with(vectors, estimates).select("grp", *_X, _distance().alias("d"))
        limit = stage(near.groupBy("grp").agg(F.percentile_approx("d", support, 1000).alias("limit")), "limits")
        moments = _with(near, limit).filter(F.col("d") <= F.col("limit")).groupBy("grp").agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)],
            *[F.covar_pop(_X[i], _X[j]).alias(f"c{i}{j}") for i in range(DIMENSIONS) for j in range(i + 1)])
        estimates = _estimates(moments, lambda i, j: F.col(f"c{i}{j}"))
    far = _with(rows, estimates).withColumn("d", _distance())
    scale = stage(far.groupBy("grp").agg(F.greatest(F.percentile_approx("d", 0.5, 1000) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"),
                                         F.count(F.lit(1)).alias("size")), "scales")
    judged = _with(far, scale).withColumn("distance", F.col("d") / F.col("scale"))
    outlier = (F.col("distance") > cutoff) & (F.col("size") > 2 * DIMENSIONS)
    return judged.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         (~failed & ~outlier).alias("kept"), "distance")
