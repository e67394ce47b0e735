"""Hard-negative mining by a vertical scan with branch and bound (BOND).

Vectors are kept in blocks, dimension by dimension. For an anchor a block's dimensions are read in
the order of the anchor's descending magnitude, a few at a time. After each few, the least and the
most that the remaining dimensions can add follow from the block's minimum and maximum per
dimension, and candidates that can't reach a place, or a score window, leave the bitmap. What stays
to the end has its exact score.

Two scans: the first finds every anchor's best rows of its own label (the positives), the second
the best rows of other labels inside each positive's score window. In both a task keeps its best
few per anchor and window, so what is shuffled does not depend on the rows it read. Anchors are
taken in groups of bounded bytes: each group is sent to the tasks and meets all blocks.

Scores are whole numbers and exact: the arithmetic type is chosen by what a sum can reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.registry import query, table
from quayside.session import durable

SCALE, LARGEST = 256.0, 1 << 23
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
GROUP_ANCHORS, GROUP_BYTES = 16_384, 32 << 20  # anchors that a task holds at once
TASK_WORK = 1 << 27  # products a task is meant to compute
STEPS = (16, 8)  # dimensions read before the first check, and between checks
NONE = np.iinfo(np.int64).min

VECTORS = "id long, label long, vector binary"
BLOCKS = "rows int, dims int, ids binary, labels binary, columns binary"


def whole_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, with components as 32-bit whole numbers."""
    for batch in batches:
        lists = batch.column("vector").cast(pa.large_list(pa.float64()))
        values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)  # null: NaN
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        good = (bad[ends[1:]] == bad[ends[:-1]]) & np.asarray(lists.is_valid())
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.clip(np.nan_to_num(np.floor(values * SCALE)), -LARGEST, LARGEST).astype("<i4")
        picked = np.flatnonzero(good)
        vectors = pa.array([scaled[ends[r]:ends[r + 1]].tobytes() for r in picked], pa.binary())
        rows = pa.array(picked)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(rows), batch.column("label").take(rows), vectors], ["id", "label", "vector"])


def matrix(vectors: list[bytes]) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    dims = max((len(v) for v in vectors), default=0) // 4
    out = np.zeros((len(vectors), dims), np.int32)
    for row, v in enumerate(vectors):
        out[row, :len(v) // 4] = np.frombuffer(v, "<i4")
    return out


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of bounded rows and bytes, rows ordered by label, one dimension after the other."""
    held: list[tuple] = []
    size = 0

    def block() -> pa.RecordBatch:
        held.sort(key=lambda r: r[1])
        columns = np.ascontiguousarray(matrix([r[2] for r in held]).T)
        ids, labels = (np.array([r[k] for r in held], "<i8").tobytes() for k in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(held)], pa.int32()), pa.array([len(columns)], pa.int32()), pa.array([ids], pa.binary()),
             pa.array([labels], pa.binary()), pa.array([columns.tobytes()], pa.binary())],
            ["rows", "dims", "ids", "labels", "columns"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "vector"))):
            held.append(row)
            size = max(size, len(row[2]))
            if len(held) >= BLOCK_ROWS or size * len(held) >= BLOCK_BYTES:
                yield block()
                held, size = [], 0
    if held:
        yield block()


@dataclass
class Block:
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray  # dimensions x rows

    def __post_init__(self):
        self.low, self.high = self.columns.min(1).astype(np.int64), self.columns.max(1).astype(np.int64)
        self.largest = int(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0)))
        self._typed: dict = {}

    def typed(self, kind) -> np.ndarray:
        if kind not in self._typed:
            self._typed[kind] = self.columns.astype(kind)
        return self._typed[kind]


def exact_type(largest: int):
    """The fastest type that holds every partial sum up to ``largest`` exactly."""
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64


def bond(block: Block, q: np.ndarray, rows: np.ndarray, hopeful) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``rows`` that ``hopeful(least, most)`` keeps to the end, and their exact scores.

    ``hopeful`` gets the bounds of the remaining candidates' scores and says which may still count.
    """
    dims = min(len(q), len(block.columns))
    q = q[:dims].astype(np.int64)
    kind = exact_type(int(np.abs(q).max(initial=0)) * block.largest * max(dims, 1))
    order = np.argsort(-np.abs(q), kind="stable")
    ordered = q[order]
    ends = ordered * block.low[order], ordered * block.high[order]
    rest_low = np.concatenate([np.cumsum(np.minimum(*ends)[::-1])[::-1], [0]])
    rest_high = np.concatenate([np.cumsum(np.maximum(*ends)[::-1])[::-1], [0]])
    columns, weights = block.typed(kind), ordered.astype(kind)
    partial = np.zeros(len(rows), kind)
    done, step = 0, STEPS[0]
    while done < dims and len(rows):
        stop = min(done + step, dims)
        read = order[done:stop]
        part = columns[read] if len(rows) == columns.shape[1] else columns[read[:, None], rows]
        partial += weights[done:stop] @ part
        done, step = stop, STEPS[1]
        keep = hopeful(partial + kind(rest_low[done]), partial + kind(rest_high[done]))
        if not keep.all():
            rows, partial = rows[keep], partial[keep]
    if not dims and len(rows):
        keep = hopeful(partial, partial)
        rows, partial = rows[keep], partial[keep]
    return rows, partial.astype(np.int64)


class Best:
    """The best few (score, smaller id first) of one place, kept over blocks."""

    __slots__ = ("most", "scores", "ids")

    def __init__(self, most: int):
        self.most, self.scores, self.ids = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def needed(self) -> int:
        """The score that a candidate must at least reach."""
        return int(self.scores[-1]) if len(self.scores) == self.most else NONE

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[:self.most]
        self.scores, self.ids = scores[first], ids[first]


def scan_positives(block: Block, anchor: int, label: int, q: np.ndarray, best: Best) -> None:
    """Add the block's best rows of the anchor's label."""
    rows = np.arange(*np.searchsorted(block.labels, [label, label + 1]))
    rows = rows[block.ids[rows] != anchor]
    most, floor = best.most, best.needed()

    def hopeful(least: np.ndarray, top: np.ndarray) -> np.ndarray:
        needed = floor
        if len(least) > most:
            needed = max(needed, int(np.partition(least, len(least) - most)[len(least) - most]))
        return top >= needed

    rows, scores = bond(block, q, rows, hopeful)
    best.add(scores, block.ids[rows])


def window(score: int) -> int:
    """The least negative score of a positive's window; the most is the positive's own."""
    return -(-LEAST_PERCENT * score // 100)


def scan_negatives(
    block: Block, anchor: int, label: int, q: np.ndarray, tops: np.ndarray, best: list[Best]
) -> None:
    """Add the block's best rows of other labels to each window, given by its top score."""
    spans = sorted((max(window(int(t)), b.needed()), int(t)) for t, b in zip(tops, best))
    spans = [s for s in spans if s[0] <= s[1]]
    if not spans:
        return
    merged = [list(spans[0])]
    for low, high in spans[1:]:
        if low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    a, b = np.searchsorted(block.labels, [label, label + 1])
    everything = np.arange(len(block.labels))
    rows = np.concatenate([everything[:a], everything[b:]]) if b > a else everything

    def hopeful(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        keep = (most >= merged[0][0]) & (least <= merged[0][1])
        for low, high in merged[1:]:
            keep |= (most >= low) & (least <= high)
        return keep

    rows, scores = bond(block, q, rows, hopeful)
    ids = block.ids[rows]
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    for top, held in zip(tops, best):
        first = int(np.searchsorted(-scores, -int(top)))
        last = min(int(np.searchsorted(-scores, -max(window(int(top)), held.needed()), "right")), first + held.most)
        if last > first:
            held.add(scores[first:last], ids[first:last])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for n, dims, ids, labels, columns in zip(*(batch.column(c).to_pylist() for c in (
                "rows", "dims", "ids", "labels", "columns"))):
            yield Block(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"),
                        np.frombuffer(columns, "<i4").reshape(dims, n))


def _best_rows(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each key by score and id, with their rank."""
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.desc("score"), "id")).cast("int"))
    return ranked.filter(F.col("rank") <= most)


def _mine_group(blocks: DataFrame, anchors: pa.Table, positives: int, negatives: int) -> DataFrame:
    """All results of one group of anchors, which fits a task."""
    spark = blocks.sparkSession
    ids, labels = (anchors.column(c).to_numpy() for c in ("id", "label"))
    share = spark.sparkContext.broadcast((ids, labels, matrix(anchors.column("vector").to_pylist())))

    def best_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = share.value
        best = [Best(positives) for _ in ids]
        for block in blocks_of(batches):
            for k in range(len(ids)):
                scan_positives(block, ids[k], labels[k], vectors[k], best[k])
        yield from emit([(k, None, b) for k, b in enumerate(best)])

    def emit(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = [f for f in found if len(f[2].ids)]
        if found:
            sizes = [len(b.ids) for _, _, b in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([k for k, _, _ in found], sizes).astype(np.int64)),
                pa.array(np.repeat([t or 0 for _, t, _ in found], sizes).astype(np.int64)),
                pa.array(np.concatenate([b.ids for _, _, b in found])),
                pa.array(np.concatenate([b.scores for _, _, b in found])),
            ], ["anchor", "top", "id", "score"])

    kinds = "anchor long, top long, id long, score long"
    near = durable(_best_rows(blocks.mapInArrow(best_positives, kinds), ["anchor"], positives).select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # At most ``positives`` tops for each anchor of the group. A negative score has an empty window.
    asked = near.filter(F.col("positive_score") >= 0).select("anchor", "positive_score").distinct().toArrow()
    order = np.lexsort((asked.column("positive_score").to_numpy(), asked.column("anchor").to_numpy()))
    of, tops = (asked.column(c).to_numpy()[order] for c in ("anchor", "positive_score"))
    windows = spark.sparkContext.broadcast((np.searchsorted(of, np.arange(len(ids) + 1)), tops))

    def best_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = share.value
        firsts, tops = windows.value
        best = [Best(negatives) for _ in tops]
        for block in blocks_of(batches):
            for k in range(len(ids)):
                a, b = firsts[k], firsts[k + 1]
                scan_negatives(block, ids[k], labels[k], vectors[k], tops[a:b], best[a:b])
        yield from emit([(k, int(tops[j]), best[j]) for k in range(len(ids)) for j in range(firsts[k], firsts[k + 1])])

    far = _best_rows(blocks.mapInArrow(best_negatives, kinds), ["anchor", "top"], negatives)
    named = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(len(ids))), "anchor_id": pa.array(ids)}))
    return durable(
        near.withColumnRenamed("positive_score", "top")
        .join(far, ["anchor", "top"]).join(F.broadcast(named), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                F.col("top").alias("positive_score"), F.col("score").alias("negative_score")),
        "negatives")


def mine_negatives(
    rows: DataFrame, every: int = 100, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    Anchors are the rows whose id is divisible by ``every``. Rows without id, label or vector, or
    with a component that is null or not finite, take no part. Components are floor(256 x), held
    within 2^23 either way; a shorter vector ends in zeros. Repeated rows are listed as often as
    they occur, an anchor's own id never; an anchor that occurs several times with the same label
    and vector is asked once. Positives below zero have empty windows. Other columns are left out.
    An empty table gives no rows.
    """
    spark = rows.sparkSession
    source = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    anchors = durable(
        source.filter(F.col("id") % every == 0).mapInArrow(whole_vectors, VECTORS).distinct(), "anchors")
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vector")).alias("bytes")).first()
    count = source.count()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    if not size["n"]:
        return empty
    width = max(size["bytes"], 4)
    files = -(-count // BLOCK_ROWS)
    blocks = durable(source.repartition(files).mapInArrow(whole_vectors, VECTORS).mapInArrow(pack, BLOCKS), "blocks")
    tasks = min(files, -(-count * size["n"] * width // 4 // TASK_WORK))
    groups = -(-size["n"] // min(GROUP_ANCHORS, max(GROUP_BYTES // width, 1)))
    found = []
    for g in range(groups):
        picked = anchors.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(groups)) == g).toArrow()
        if picked.num_rows:
            found.append(_mine_group(blocks.repartition(max(tasks, 1)), picked.combine_chunks(), positives, negatives))
    return reduce(DataFrame.unionByName, found, empty)


NEGATIVES_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id AS id,
         CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM r a JOIN r o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after each seventh label has moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine_negatives(moved)
