"""Records of delimited files whose quoted fields hold newlines, read in splits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.skew import fits_broadcast
from quayside.session import durable

# What a line does to the state "inside a quoted field": keeps it, as every line without a quote
# does, ends outside or inside whatever it was, or turns it.
KEEPS, OUTSIDE, INSIDE, TURNS = 0, 1, 2, 3


def open_quote(delimiter: str, quote: str = '"') -> str:
    """A pattern for a text that starts at a field and ends inside a quoted one.

    A field is quoted when it begins with the quote; doubled quotes belong to it. What follows a
    closing quote up to the delimiter is no quoting, nor is a quote inside a bare field.
    """
    q, d = re.escape(quote), re.escape(delimiter)
    quoted = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    rest = f"(?:(?!{d}).)*+" if len(delimiter) > 1 else f"[^{d}]*+"
    return f"(?s)\\A(?:(?:{quoted}{q}(?!{q}){rest}|(?!{q}){rest}){d})*+{quoted}\\z"


def line_effect(line: Column, delimiter: str = ",", quote: str = '"') -> Column:
    """KEEPS, OUTSIDE, INSIDE or TURNS: a line that starts inside a quoted field is like one with
    the quote before it."""
    pattern = open_quote(delimiter, quote)
    after_outside = line.rlike(pattern)
    after_inside = F.concat(F.lit(quote), line).rlike(pattern)
    return F.when(~line.contains(quote), KEEPS).when(
        after_outside, F.when(after_inside, INSIDE).otherwise(TURNS)
    ).otherwise(F.when(after_inside, KEEPS).otherwise(OUTSIDE)).cast("int")


def _running(effects: np.ndarray, start: int) -> np.ndarray:
    """The state before each line and behind the last one, from a first state: the last line with a
    fixed outcome decides, and the turns since then."""
    fixed = np.flatnonzero((effects == OUTSIDE) | (effects == INSIDE))
    turns = np.concatenate([[0], np.cumsum(effects == TURNS)])
    base, since = np.full(len(effects) + 1, start), np.zeros(len(effects) + 1, np.int64)
    if len(fixed):
        last = np.searchsorted(fixed, np.arange(len(effects) + 1)) - 1  # before each line
        seen = last >= 0
        base[seen] = effects[fixed[last[seen]]] == INSIDE
        since[seen] = turns[fixed[last[seen]] + 1]
    return (base + turns - since) % 2


STATES = "inside_0 int, inside_1 int, record_0 long, record_1 long"


def _states(lines: DataFrame, ends: bool = False) -> DataFrame:
    """Each line with its state and record number inside its block, for a block that starts outside
    (0) and for one that starts inside (1) a quoted field. ``ends``: only a row per block, with the
    last slot, the state behind it and the records of the block.

    One pass over the lines in the order of the scan; the state is carried from batch to batch.
    """
    import pyarrow as pa

    end_names = ("path", "_block", "_slot", "inside_0", "inside_1", "record_0", "record_1")
    end_shape = pa.schema(list(zip(end_names, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, count, slot = None, [0, 1], [0, 0], 0

        def end() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(end_names, (*at, slot, *state, *count)))], end_shape)

        for batch in batches:
            if not batch.num_rows:
                continue
            paths = batch.column("path").dictionary_encode().indices.to_numpy()
            blocks = batch.column("_block").to_numpy()
            effects = batch.column("effect").to_numpy()
            shown = batch.column("shown").to_numpy(zero_copy_only=False)
            slots = batch.column("_slot").to_numpy()
            edges = np.flatnonzero((paths[1:] != paths[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            inside = np.empty((2, batch.num_rows), np.int32)
            record = np.empty((2, batch.num_rows), np.int64)
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                here = batch.column("path")[int(a)].as_py(), int(blocks[a])
                if here != at:
                    if ends and at is not None:
                        yield end()
                    at, state, count = here, [0, 1], [0, 0]
                for h in (0, 1):
                    states = _running(effects[a:b], state[h])
                    starts = (states[:-1] == 0) & shown[a:b]
                    inside[h, a:b] = states[:-1]
                    record[h, a:b] = count[h] + np.cumsum(starts)
                    state[h], count[h] = int(states[-1]), int(record[h, b - 1])
                slot = int(slots[b - 1])
            if ends:
                continue
            names = [f.name for f in batch.schema]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x) for x in (*inside, *record))],
                [*names, "inside_0", "inside_1", "record_0", "record_1"])
        if ends and at is not None:
            yield end()

    if ends:
        return lines.mapInArrow(run, f"path string, _block long, _slot long, {STATES}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema)
    return lines.mapInArrow(run, f"{schema}, {STATES}")


def records(lines: DataFrame, delimiter: str = ",", quote: str = '"') -> DataFrame:
    """The records of files: path, line_no (0-based place of the record in its file, blank lines
    not counted), line (its text), open (true for a record whose quote is never closed).

    ``lines`` come from ``read_lines(keep_cr=True)`` and are not shuffled: each split runs through
    its quotes for both possible states at its start, a table with a row per split tells which one
    holds and how many records came before, and only lines of records that span several lines meet
    by (file, record). A record may cross any number of splits. A carriage return at the end of a
    record is no part of it, inside quotes it is.

    A quote that is open at the end of a file makes no record of the rest of the file: the line
    that opened it is the record, marked ``open``, and the lines below it are left out.
    """
    judged = _judged(lines, delimiter, quote)
    seen = _states(judged)
    known = durable(_splits(judged), "splits")
    if fits_broadcast(known):
        known = F.broadcast(known)

    chosen = F.col("start") == 1
    inside = F.when(chosen, F.col("inside_1")).otherwise(F.col("inside_0"))
    number = F.when(chosen, F.col("record_1")).otherwise(F.col("record_0"))
    effect = F.col("effect")
    placed_lines = seen.join(known, ["path", "_block"]).select(
        "path", (number + F.col("shift")).alias("line_no"), "_block", "_slot", "line", inside.alias("inside"), "shown",
        F.when(effect == KEEPS, inside).when(effect == TURNS, 1 - inside).otherwise(effect - 1).alias("leaves"),
        ((F.col("unclosed") == 1) & (number + F.col("shift") == F.col("records") - 1)).alias("open"),
    ).filter((F.col("inside") == 1) | F.col("shown"))
    single = (F.col("inside") == 0) & ((F.col("leaves") == 0) | F.col("open"))
    alone = placed_lines.filter(single).select("path", "line_no", _without_cr(F.col("line")).alias("line"), "open")
    pieces = placed_lines.filter(~single & ~F.col("open"))
    joined = pieces.groupBy("path", "line_no").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_slot", "line"))).alias("lines")
    ).select("path", "line_no", _without_cr(F.array_join("lines.line", "\n")).alias("line"), F.lit(False).alias("open"))
    return alone.unionByName(joined)


def record_counts(lines: DataFrame, delimiter: str = ",", quote: str = '"') -> DataFrame:
    """How many ``records`` each file has: one pass over the lines, of which no text leaves the scan."""
    return _splits(_judged(lines, delimiter, quote)).groupBy("path").agg(F.max("records").alias("records"))


def _judged(lines: DataFrame, delimiter: str, quote: str) -> DataFrame:
    shown = F.trim(F.rtrim("line", F.lit("\r"))) != ""
    return lines.select(
        "path", "_block", "_slot", "line", line_effect(F.col("line"), delimiter, quote).alias("effect"),
        shown.alias("shown"))


def _splits(judged: DataFrame) -> DataFrame:
    """A row per split: the state at its start, the records before it, those of its file, and whether
    the file ends inside a quoted field. The texts take no part in this pass."""
    blocks = _states(judged.drop("line"), ends=True).groupBy("path", "_block").agg(
        F.max("record_0").alias("n_0"), F.max("record_1").alias("n_1"),
        F.max_by(F.struct("inside_0", "inside_1"), "_slot").alias("last"))
    ended = blocks.withColumns({"end_0": F.col("last.inside_0"), "end_1": F.col("last.inside_1")})
    order = Window.partitionBy("path").orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed, turned = F.col("end_0") == F.col("end_1"), (F.col("end_0") == 1) & (F.col("end_1") == 0)
    counted = ended.withColumn("turns", F.sum(turned.cast("int")).over(order))
    start = (
        F.coalesce(F.last(F.when(fixed, F.col("end_0")), ignorenulls=True).over(before), F.lit(0))
        + F.coalesce(F.last("turns").over(before), F.lit(0))
        - F.coalesce(F.last(F.when(fixed, F.col("turns")), ignorenulls=True).over(before), F.lit(0))
    ) % 2
    placed = counted.withColumn("start", start.cast("int"))
    own = F.when(F.col("start") == 1, F.col("n_1")).otherwise(F.col("n_0"))
    final = F.when(F.col("start") == 1, F.col("end_1")).otherwise(F.col("end_0"))
    whole = Window.partitionBy("path").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return placed.select(
        "path", "_block", "start", (F.coalesce(F.sum(own).over(before), F.lit(0)) - 1).alias("shift"),
        F.sum(own).over(whole).alias("records"), F.last(final).over(whole).alias("unclosed"))


def _without_cr(text: Column) -> Column:
    return F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
