"""Ranking, numbering and running totals that never need a whole group in one task.

Spark evaluates a window partition in a single task. That is fine for windows
over aggregates with few rows, and for top-n filters, which Spark applies before
the shuffle. Numbering *all* rows of a table or of a large group is different:
here the rows are range-partitioned and written once, each range is numbered on
its own, and the ranges are stitched together with one small offset per range.
The written table also pins the range boundaries, so a recomputed task cannot
see different ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.scratch import scratch_path

_SLOT = "_slot"
_RANGE = "_range"
# monotonically_increasing_id keeps the partition number above the low 33 bits.
_ROW_BITS = 33


def _write_in_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in range partitions, with each row's range and place within it in one long."""
    spark = df.sparkSession
    path = scratch_path(spark, "ordered")
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    ordered.write.parquet(path)
    written = spark.read.schema(ordered.schema).parquet(path)
    return written.withColumn(_RANGE, F.shiftright(_SLOT, _ROW_BITS))


def with_global_index(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number all rows 1..n in the given order.

    Equals ``row_number() over (order by ...)`` for a unique order, without
    moving the table into one partition.
    """
    ordered = _write_in_order(df, order)
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: bounded by the partition count, whatever the data.
    offsets = (
        ordered.groupBy(_RANGE)
        .agg(F.count("*").alias("_n"))
        .select(_RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col(_SLOT) - F.shiftleft(F.col(_RANGE), _ROW_BITS)
    return (
        ordered.join(F.broadcast(offsets), _RANGE)
        .withColumn(name, F.col("_offset") + place + 1)
        .drop(_SLOT, _RANGE, "_offset")
    )


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of key columns in which a null group is a group like any other."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def _running(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], measure: str, name: str, total: str
) -> DataFrame:
    ordered = _write_in_order(df, [*group, *order])
    inside = (
        Window.partitionBy(_RANGE, *group)
        .orderBy(_SLOT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    by_group = Window.partitionBy(*group)
    earlier = by_group.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range partition and one more per group.
    pieces = (
        ordered.groupBy(_RANGE, *group)
        .agg(F.sum(measure).alias("_sum"))
        .select(
            _RANGE,
            *group,
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_sum").over(by_group).alias(total),
        )
    )
    rows = ordered.withColumn("_inside", F.coalesce(F.sum(measure).over(inside), F.lit(0)))
    joined = rows.join(pieces, _same(rows, pieces, [_RANGE, *group]))
    for c in (_RANGE, *group):
        joined = joined.drop(pieces[c])
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop(_SLOT, _RANGE, "_before", "_inside")


def with_running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], measure: str, name: str
) -> DataFrame:
    """Running sum of ``measure`` within each group, in the given (unique) order; nulls add nothing."""
    return _running(df, group, order, measure, name, "_total").drop("_total")


def with_dense_rank(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Dense rank by descending value within each group, every row kept; nulls rank last.

    Equal values share a rank, so it is the distinct (group, value) pairs that are
    counted. The rows are written once and serve both the pairs and the join back.
    """
    path = scratch_path(df.sparkSession, "ranked")
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    pairs = rows.select(group, value).distinct().withColumn("_one", F.lit(1))
    ranks = with_running_total(pairs, [group], [F.col(value).desc()], "_one", "_rank")
    joined = rows.join(ranks, _same(rows, ranks, [group, value]))
    return joined.select(*[rows[c] for c in rows.columns], ranks["_rank"].cast("int").alias(name))


def group_quantiles(
    df: DataFrame, group: str, value: str, probabilities: dict[str, str]
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per named probability.

    Works on counts per distinct value, so a group is never sorted or buffered in
    one task however many rows it has. ``n_rows`` and the positions count values, not
    nulls; a group of nulls alone has none and null quantiles.
    """
    counts = df.groupBy(group, value).agg(F.count(value).alias("_n"))
    reached = _running(counts, [group], [value], "_n", "_upto", "_rows")
    picks, results = [], []
    for name, probability in probabilities.items():
        position = F.lit(Decimal(probability)) * (F.col("_rows") - 1)
        for end, place in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.min(F.when(F.col("_upto") > place, F.col(value))).alias(f"_{end}_{name}"))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        results.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return (
        reached.groupBy(group, "_rows")
        .agg(*picks)
        .select(group, F.col("_rows").alias("n_rows"), *results)
    )


def top_n_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, name: str = "rn"
) -> DataFrame:
    """First n rows of each group. The filter next to the window lets Spark keep
    only n rows per group and task before the shuffle, so a hot group stays cheap."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def concentration(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n largest rows with the grand total and the running total down to each value.

    Rows with equal values share the running total (a range frame), counting all
    of them even when only some make the top n. Values are summed per distinct
    value first; the n largest rows cannot span more than n distinct values, so
    the running total needs just the n largest of those sums.
    """
    top = df.orderBy(F.col(value).desc(), F.col(key)).limit(n)
    by_value = df.groupBy(value).agg(F.sum(value).alias("_sum")).orderBy(F.col(value).desc()).limit(n)
    down = Window.orderBy(F.col(value).desc())
    running = by_value.select(value, F.sum("_sum").over(down).alias("running_total"))
    total = df.agg(F.sum(value).alias("grand_total"))
    ranked = top.withColumn("rn", F.row_number().over(down.orderBy(F.col(value).desc(), F.col(key))))
    # Both right sides are bounded: n rows and one row.
    return ranked.join(F.broadcast(running), value).crossJoin(F.broadcast(total))
