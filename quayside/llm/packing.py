"""Best-two-fit packing of documents into sequences of at most ``size`` tokens.

Only lengths matter for packing, and there are at most ``size`` of them. So the plan is made from
the histogram of lengths, and a bin of the plan stands for as many equal sequences as its lengths
allow: it is filled greedily, longest document first; then its smallest document is replaced by two
unpacked ones whenever two fit the expanded gap more tightly. Histogram and plan are bounded by the
sequence size alone and hold all documents of the corpus, so packing is global.

Documents find their places by rank among those of their length: a rank inside the task, plus the
number of that length in earlier tasks. No length is gathered in one task, however common it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.registry import query, table
from quayside.llm.text import text_slabs
from quayside.llm.tokens import Encoder, vocabulary_path
from quayside.session import durable

SIZE = 2048
_RANKS = 1 << 44


def plan(counts: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, sequences, first sequence, offset) for a histogram of lengths.

    Rank r of a length in a row's range [first, first + sequences * documents) lies in sequence
    ``first sequence + (r - first) % sequences`` at ``offset + (r - first) // sequences * length``.
    """
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    rows, sequence = [], 0
    while left.any():
        taken: dict[int, int] = {}
        gap = size

        def available(most: int, own: dict[int, int]) -> int:
            """The longest length up to ``most`` with a document left over from ``own``."""
            for k in range(min(most, size), 0, -1):
                if left[k] > own.get(k, 0):
                    return k
            return 0

        while k := available(gap, taken):
            # As many of this length as fit, at once.
            many = min(gap // k, int(left[k]) - taken.get(k, 0))
            taken[k] = taken.get(k, 0) + many
            gap -= many * k
        while gap and sum(taken.values()) > 1:
            small = min(taken)
            room = gap + small
            rest = {**taken, small: taken[small] - 1}
            best = (small, 0, 0)
            first = available(room - 1, rest)
            while first and 2 * first > best[0]:
                second = available(min(first, room - first), {**rest, first: rest.get(first, 0) + 1})
                if second and first + second > best[0]:
                    best = (first + second, first, second)
                if best[0] == room:
                    break
                first = available(first - 1, rest)
            if not best[1]:
                break
            taken = rest
            for k in best[1:]:
                taken[k] = taken.get(k, 0) + 1
            taken = {k: n for k, n in taken.items() if n}
            gap = room - best[0]
        times = min(int(left[k]) // n for k, n in taken.items())
        offset = 0
        for k, n in sorted(taken.items(), reverse=True):
            rows.append((k, int(used[k]), times, sequence, offset))
            used[k] += n * times
            left[k] -= n * times
            offset += n * k
        sequence += times
    return rows


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; of a longer one the first may be shorter."""
    head = length % size or size
    bounds = [0, *range(head, length + 1, size)] if length > size else [0, length]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, vocabulary: str | None = None
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its closing id 0 alone. Repeated rows are packed as often as they
    occur; a null id is carried along. Other columns are left out. An empty table gives no rows.
    """
    path = vocabulary or vocabulary_path()
    spark = docs.sparkSession

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import random

        encoder, part = Encoder(path), random.getrandbits(62)
        ranks = np.zeros(size + 1, np.int64)
        for batch, data, offsets in text_slabs(batches, "text"):
            ids, starts, lengths, crcs, numbers, places, rows = [], [], [], [], [], [], []
            data = data.tobytes()
            for row in range(len(offsets) - 1):
                got = np.append(encoder.encode(data[offsets[row]:offsets[row + 1]].decode()), 0).astype("<u4")
                for number, (start, length) in enumerate(cut(len(got), size)):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(got[start:start + length].tobytes()))
                    places.append(ranks[length])
                    ranks[length] += 1
            ids = batch.column("id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(crcs, pa.int64()), pa.array(np.full(len(rows), part)), pa.array(places, pa.int64()),
            ], ["id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    made = durable(source.mapInArrow(
        pieces, f"id {kind}, piece int, start long, length long, ids_crc32 long, part long, rank long"), "pieces")

    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("rows"))
    # A group of this window has a row per task at most.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("part", "length", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    histogram = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("rows").alias("rows")).collect():  # at most ``size`` rows
        histogram[r["length"]] = r["rows"]
    steps = np.array(sorted(plan(histogram, size)), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(steps)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        keys = steps[:, 0] * _RANKS + steps[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("shift").to_numpy()
            step = steps[np.searchsorted(keys, length * _RANKS + rank, "right") - 1]
            nth = rank - step[:, 1]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")],
                pa.array(step[:, 3] + nth % step[:, 2]), pa.array(step[:, 4] + nth // step[:, 2] * length),
            ], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return made.join(shifts, ["part", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", "rank", "shift"
    ).mapInArrow(
        place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    ).withColumnRenamed("id", doc_id)


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
