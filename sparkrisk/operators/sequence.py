"""Per-entity ordered windows (W1-W5) that survive hot keys.

A plain ``Window.partitionBy(key)`` sends every row of one key to one task. If a single
entity holds a third of the rows, that task holds a third of the data. ``strategy="range"``
(the default) avoids this:

1. Spark cuts the data into ordered ranges of similar size by (key, time, ties), so a hot key
   is spread over many partitions, and so are the rows of a hot key that share one time, with
   sums over (key, time) groups too.
2. Windows run per (partition, key) with the full order (time, ties). The rows are moved
   once more, range-partitioned on the partition id, which gives the windows their
   (partition, key) clustering with about one range per task (a hash of (partition, key)
   would let several chunks of a hot key collide in one task). The result is written once
   as a parquet stage in the shared checkpoint folder: both later branches must see the
   same partition ids, and a second plan of the range exchange would sample its own bounds
   (and recompute the whole input).
3. Only the first and the last key of a range can continue in another one. The local windows
   mark the last row of those keys; it carries their count, running sums and lag sources. So
   the correction reads at most two rows per range (no aggregate over the data), combines them
   with a window over ranges, and is broadcast: its bound is twice the partition count.
4. Sums over (key, time) groups are peer sums of the range at first. Only the group of a range's
   first row and that of its last row can continue in another range; these two rows are marked, the
   parts of a group are added up, and the totals are broadcast as one row per range. The row before
   the current one, whose sums a lag reads, is in the same range (or is a marked row of 3.), so the
   same row of the range corrects it.

``strategy="hash"`` is the plain window, one shuffle, for data known to be free of hot keys.

W5 (latest row per key) is ``row_number() = 1``, which Spark plans with a group limit before the
shuffle: every task sends at most one row per key, so a hot key is reduced in the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.session import materialize

_PID = "__seq_pid"
_LRN = "__seq_lrn"
_EDGE = "__seq_edge"
_GEDGE = "__seq_gedge"
_PTIME = "__seq_ptime"


def _order(time: str, ties: Sequence[str]) -> list[Column]:
    # Ascending, nulls first: a null event time sorts before every other event.
    return [F.col(c).asc_nulls_first() for c in (time, *ties)]


def ordered_window(
    df: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str] = (),
    row_number: str | None = None,
    lags: Mapping[str, str] | None = None,
    group_sums: Mapping[str, str] | None = None,
    running_sums: Mapping[str, str] | None = None,
    strategy: str = "range",
    num_partitions: int | None = None,
    null_time_sum=None,
) -> DataFrame:
    """Add per-key ordered columns.

    - ``row_number``: name of a 1..n bigint ordinal per key (W1).
    - ``lags``: ``{out: src}``, value of ``src`` on the previous row of the key (W2, W4).
    - ``group_sums``: ``{out: src}``, sum of ``src`` over rows with the same (key, time),
      computed before the lags, so a lag may read a group sum. A null time forms no group
      and gives ``null_time_sum``.
    - ``running_sums``: ``{out: src}``, sum of ``src`` over the key's rows up to and
      including this one (a prefix sum; with a constant key, a global one). ``src`` is a column of
      ``df``, not a group sum.

    The order is ``time`` then ``ties``, all ascending with nulls first. Rows with a null
    key form one group, as in a SQL window.

    With ``strategy="range"`` the call itself runs a job: it writes the window stage. Jobs own
    it through ``session.stage_scope``.
    """
    lags = dict(lags or {})
    group_sums = dict(group_sums or {})
    running = dict(running_sums or {})
    if strategy == "hash":
        return _hash_window(df, key, time, ties, row_number, lags, group_sums, null_time_sum, running)
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")

    # Without a fixed count, adaptive execution may merge neighbouring ranges to its target
    # size; merged ranges are still contiguous and ordered, which is all the correction needs.
    if set(running.values()) & set(group_sums):
        raise ValueError("a running sum cannot read a group sum")
    order = [F.col(key).asc_nulls_first(), *_order(time, ties)]
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = ranged.withColumn(_PID, F.spark_partition_id())
    # The windows need rows clustered by (range, key). Range ids all carry about the same
    # number of rows, so range-partitioning on the id puts about one range per task; a hash
    # of (range, key) would let several chunks of a hot key collide in one task. A range
    # partitioning on the id alone satisfies the windows' clustering: no further exchange.
    by_id = F.col(_PID).asc()
    ranged = ranged.repartitionByRange(num_partitions, by_id) if num_partitions else ranged.repartitionByRange(by_id)

    # A lagged group sum needs the time of the group it was taken from.
    of_group = {out: src for out, src in lags.items() if src in group_sums}
    times = {_PTIME: time} if of_group else {}
    local = _hash_window(ranged, key, time, ties, _LRN, lags | times, group_sums, null_time_sum, running, part=[_PID])
    # The last row of the range's first key, and the range's last row.
    of_key = Window.partitionBy(_PID, key).orderBy(*_order(time, ties))
    of_range = Window.partitionBy(_PID).orderBy(F.col(key).asc_nulls_first(), *_order(time, ties))
    upto = of_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_key = F.first(F.struct(F.col(key).alias("k"))).over(upto)["k"]
    local = local.withColumns({
        _EDGE: F.lead(F.lit(1)).over(of_key).isNull()
        & (F.lead(F.lit(1)).over(of_range).isNull() | F.col(key).eqNullSafe(first_key))
    })
    if group_sums:  # the range's first and last row, whose groups may continue
        local = local.withColumn(_GEDGE, F.lag(F.lit(1)).over(of_range).isNull() | F.lead(F.lit(1)).over(of_range).isNull())
    local = materialize(local)
    if group_sums:
        local = _whole_groups(local, key, time, list(group_sums), of_group)

    srcs = sorted(set(lags.values()))
    by_part = Window.partitionBy("__seq_key").orderBy("__seq_cpid")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    edges = local.filter(F.col(_EDGE)).select(
        F.col(_PID).alias("__seq_cpid"),
        F.col(key).alias("__seq_key"),
        F.col(_LRN).alias("__seq_cnt"),
        F.struct(*[F.col(c) for c in srcs] or [F.lit(None).alias("none")]).alias("__seq_last"),
        *[F.col(out).alias(f"__seq_s{i}") for i, out in enumerate(running)],
    )
    summary = edges.select(
        "__seq_cpid",
        "__seq_key",
        F.sum("__seq_cnt").over(before).alias("__seq_off"),
        F.lag("__seq_last").over(by_part).alias("__seq_prev"),
        *[F.sum(f"__seq_s{i}").over(before).alias(f"__seq_o{i}") for i in range(len(running))],
    ).filter(F.col("__seq_off").isNotNull())
    # At most two rows per range.
    corr = F.broadcast(summary)
    on = (F.col(_PID) == F.col("__seq_cpid")) & F.col(key).eqNullSafe(F.col("__seq_key"))
    joined = local.join(corr, on, "left")

    first = F.col(_LRN) == 1
    cols = {}
    for out, src in lags.items():
        cols[out] = F.when(first, F.col("__seq_prev").getField(src)).otherwise(F.col(out))
    for i, out in enumerate(running):
        cols[out] = F.col(out) + F.coalesce(F.col(f"__seq_o{i}"), F.lit(0))
    if row_number is not None:
        cols[row_number] = F.col(_LRN) + F.coalesce(F.col("__seq_off"), F.lit(0))
    out = joined.withColumns(cols)
    internal = [_PID, _LRN, _EDGE, _GEDGE, _PTIME, "__seq_cpid", "__seq_key", "__seq_off", "__seq_prev"]
    return out.drop(*internal, *[f"__seq_o{i}" for i in range(len(running))])


def _whole_groups(local: DataFrame, key: str, time: str, sums: Sequence[str], lagged: Mapping[str, str]) -> DataFrame:
    """Group sums of whole (key, time) groups, and lags of them, from the sums of each range's part."""
    types = {o: local.schema[o].dataType for o in sums}
    parts = local.filter(F.col(_GEDGE) & F.col(time).isNotNull()).select(
        F.col(_PID).alias("__seq_gpid"), F.col(key).alias("k"), F.col(time).alias("t"), *sums).dropDuplicates(["__seq_gpid", "k", "t"])
    whole = Window.partitionBy("k", "t")
    totals = parts.withColumns({**{o: F.sum(o).over(whole).cast(types[o]) for o in sums},
                                "__seq_parts": F.count(F.lit(1)).over(whole)}).filter("__seq_parts > 1")
    # At most two groups a range, one row per range.
    of_range = totals.groupBy("__seq_gpid").agg(F.collect_list(F.struct("k", "t", *sums)).alias("__seq_groups"))
    joined = local.join(F.broadcast(of_range), F.col(_PID) == F.col("__seq_gpid"), "left")

    def fixed(own: str, total: str, at: str) -> Column:
        out = F.col(own)
        for i in (0, 1):
            group = F.get("__seq_groups", F.lit(i))
            out = F.when(group["k"].eqNullSafe(F.col(key)) & (group["t"] == F.col(at)), group[total]).otherwise(out)
        return out

    # The lag of a range's first row of a key is null here and taken from the marked rows later.
    cols = {o: fixed(o, o, time) for o in sums}
    cols |= {out: F.when(F.col(_LRN) > 1, fixed(out, src, _PTIME)).otherwise(F.col(out)) for out, src in lagged.items()}
    return joined.withColumns(cols).drop("__seq_gpid", "__seq_groups")


def _hash_window(df, key, time, ties, row_number, lags, group_sums, null_time_sum, running=None, part=()):
    w = Window.partitionBy(*part, key).orderBy(*_order(time, ties))
    if group_sums:
        # Peers of the current time within the key: the same rows as partitionBy(key, time),
        # but on the key's partitioning, so both windows share one shuffle.
        g = Window.partitionBy(*part, key).orderBy(F.col(time).asc_nulls_first()).rangeBetween(
            Window.currentRow, Window.currentRow
        )
        df = df.withColumns(
            {
                o: F.when(F.col(time).isNotNull(), F.sum(s).over(g)).otherwise(F.lit(null_time_sum))
                for o, s in group_sums.items()
            }
        )
    cols = {o: F.lag(F.col(s)).over(w) for o, s in lags.items()}
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols.update({o: F.sum(F.col(s)).over(upto) for o, s in (running or {}).items()})
    if row_number is not None:
        # A count, not row_number(): ordinals may pass 2^31.
        cols[row_number] = F.count(F.lit(1)).over(upto)
    return df.withColumns(cols) if cols else df


def latest(
    df: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str] = (),
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of each key: newest time first, null time last, then ties
    descending (nulls last).

    A rank filter: Spark keeps one row per key in every task before the shuffle, and again
    after it, so a hot key arrives as one row per task.
    """
    cols = [c for c in (cols or df.columns) if c != key]
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in (time, *ties)])
    return df.withColumn("__latest", F.row_number().over(w)).filter(F.col("__latest") == 1).select(key, *cols)
