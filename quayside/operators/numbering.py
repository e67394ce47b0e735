"""Positions in a total order without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.skew import fits_broadcast
from quayside.session import durable


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    within: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Add 1-based positions by ``order``, restarting for each value of ``within``.

    ``row_number() over (partition by within order by order)`` sends a whole group to one task.
    Here the rows are range-partitioned by (within, order), so a hot group spans many partitions;
    each row gets its place inside its partition, and the rows before it come from prefix sums over
    (partition, group) counts. ``order`` should end in a unique column: ties share a partition.

    The sorted rows are written out first, because range bounds are sampled and the counts must
    describe the same partitions as the rows.
    """
    within = list(within)
    sort_keys = [*within, *order]
    fixed = durable(
        df.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_slot", 33))

    runs = fixed.groupBy("_part", *within).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first")
    )
    # A group of this window holds at most one row per range partition.
    earlier = (
        Window.partitionBy(*within)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1
    offsets = runs.select("_part", *within, shift.alias("_shift"))
    if not within or fits_broadcast(offsets):
        offsets = F.broadcast(offsets)

    left, right = fixed.alias("l"), offsets.alias("r")
    match = F.col("l._part") == F.col("r._part")
    for key in within:
        match = match & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, match).select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._slot") + F.col("r._shift")).cast("long").alias(name),
    )


def with_next(
    df: DataFrame, value: str, order: Sequence[str | Column], within: Sequence[str], name: str,
    position: str = "position",
) -> DataFrame:
    """``lead(value)`` by ``order`` inside ``within``, as a join of neighbouring positions.

    The join key (within, position) is unique, so the join is even however large a group is.
    """
    numbered = number_rows(df, order, within, position)
    following = numbered.select(
        *within, (F.col(position) - 1).alias(position), F.col(value).alias(name)
    )
    return numbered.join(following, [*within, position], "left")


def block_ranges(
    starts: DataFrame, start: str, order: Sequence[str | Column], within: Sequence[str]
) -> DataFrame:
    """Blocks numbered inside their sheet, each ending one row above the next start, which is
    not part of it; the last block of a sheet is open."""
    ranged = with_next(starts, start, order, within, "_next", "block")
    return ranged.select(
        *within, "block", F.col(start).alias("start_row"), (F.col("_next") - 1).alias("end_row")
    )
