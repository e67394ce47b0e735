"""Joins of a large side with hot keys to a side that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import durable_sized, row_bytes

# A side is broadcast only after counting that it has at most this many rows and bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE
# hot keys whatever the table size.
HOT_SHARE = 10_000
SALTS = 64


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` is within the row and byte bounds: two sums that every task sends."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= BROADCAST_BYTES


def hot_keys(rows: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``1/share`` of the rows: at most ``share`` of them, counted with
    map-side partial aggregation so that no task sees the rows of a key."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    return counts.filter(F.col("_n") * F.lit(share) > total.scalar()).select(*on)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    share: int = HOT_SHARE,
    stored: bool = False,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which has at most one row per key, whatever the key skew.

    The lookup is written to the shared folder first, so that counting and joining it do not
    compute it twice; ``stored`` says it is a table already.

    * A counted-small lookup is broadcast: ``rows`` is not shuffled.
    * Otherwise the lookup rows of hot keys (fewer than ``share``) are counted in turn and broadcast
      to the rows of those keys, or, if too large, joined by salted keys; only the remaining keys, none above ``1/share`` of the rows, are shuffled.
    * Rows with a NULL key match nothing; they pass by the shuffle instead of meeting in one task.

    ``how`` is inner, left, left_semi or left_anti.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join does not do {how!r}")
    if stored:
        small = fits_broadcast(lookup, broadcast_rows)
    else:
        lookup, count, size = durable_sized(lookup, "lookup")
        small = count <= broadcast_rows and size <= BROADCAST_BYTES
    if small:
        return rows.join(F.broadcast(lookup), on, how)

    keyed = rows.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on]))
    hot = F.broadcast(hot_keys(keyed, on, share))
    hot_rows, hot_lookup = keyed.join(hot, on, "left_semi"), lookup.join(hot, on, "left_semi")
    hot_lookup, count, size = durable_sized(hot_lookup, "hot-lookup")
    if count <= broadcast_rows and size <= BROADCAST_BYTES:
        met = hot_rows.join(F.broadcast(hot_lookup), on, how)
    else:
        # Too large to broadcast: the rows of a hot key are dealt to SALTS tasks, its one lookup
        # row to each of them.
        salted = hot_rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        copies = hot_lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = salted.join(copies, [*on, "_salt"], how).drop("_salt")
    parts = [met, keyed.join(hot, on, "left_anti").join(lookup, on, how)]
    if how in ("left", "left_anti"):
        unkeyed = rows.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on]))
        parts.append(unkeyed)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
