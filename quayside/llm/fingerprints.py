"""Document fingerprints: sets of content-defined chunk digests, weighted by chunk length.

A fingerprint is the ascending list of a text's distinct chunks, 16 hex digits each: 12 of the
chunk's digest and 4 of its length in bytes. Chunks are cut where the gear hash of the text says,
so an insertion changes only the chunks around it. Likeness is containment: the bytes in shared
chunks over the bytes of the smaller fingerprint; two empty texts are alike, an empty and another
one are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.gear import boundaries
from quayside.llm.registry import query, table
from quayside.llm.text import rows_of, slabs, spans_hash

LEAST, USUAL, MOST = 32, 64, 1024
LOOSE_PARTS = 64  # of rows without an id


def chunk_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct chunks, ascending: 48 bits of digest, 16 of length."""
    starts, firsts = boundaries(data, offsets, LEAST, USUAL, MOST)
    row = rows_of(firsts)
    ends = np.append(starts[1:], 0)
    last = firsts[1:][np.diff(firsts) > 0] - 1
    ends[last] = offsets[1:][np.diff(firsts) > 0]
    size = (ends - starts).astype(np.uint64)
    value = (spans_hash(data, starts, ends) & ~np.uint64(0xFFFF)) | size
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Containment of two chunk sets, by length, from 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = both[1:][both[1:] == both[:-1]]
    size = np.uint64(0xFFFF)
    return float((shared & size).sum() / min((a & size).sum(), (b & size).sum()))


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    out = []
    for a, b in slabs(offsets):
        value, firsts = chunk_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        out += [value[firsts[k]:firsts[k + 1]] for k in range(b - a)]
    return out


def fingerprint(chunks: np.ndarray) -> str:
    return chunks.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_chars, fingerprint; null counts as empty, other columns are left out."""
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([fingerprint(s) for s in _sets([t.encode() for t in texts])], pa.string()),
            ], ["id", "n_chars", "fingerprint"])

    return source.mapInArrow(rows, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", doc_id)


def edited_by_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited versions, and how alike they are.

    The last third of a text is replaced by the beginning of the next one, by descending id (after
    the last: the first). The id range is cut into parts at quantiles of the ids, so one shuffle
    brings neighbours together; the first text of a part also goes to the part before it. Rows of
    equal id follow each other by the hash of their text, rows without an id come last. A null text
    is empty. Other columns are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = source.agg(F.percentile_approx(
        "id", [k / parts for k in range(1, parts)], min(100 * parts, 1_000_000)).alias("cuts")).first()["cuts"]
    cuts = F.array(*[F.lit(c) for c in sorted(set(found or []))]) if found else None
    # Parts count up while ids go down: the number of cuts above the id.
    # Rows without an id come behind all others, dealt by ranges of their hash.
    below = F.lit(LOOSE_PARTS - 1) - (F.shiftright("tie", 58) + 32)
    part = F.lit(1) + below if cuts is None else F.when(F.col("id").isNull(), F.size(cuts) + 1 + below).otherwise(
        F.size(cuts) - F.size(F.filter(cuts, lambda c: c <= F.col("id"))))
    placed = source.withColumn("part", part.cast("int"))

    heads = sorted(placed.groupBy("part").agg(
        F.max(F.struct("id", "tie")).alias("head")).collect(), key=lambda r: r["part"])  # a row per part
    before = [
        (heads[k - 1]["part"], row["head"]["id"], row["head"]["tie"]) for k, row in enumerate(heads)
    ]
    kind = source.schema["id"].dataType.simpleString()
    wanted = spark.createDataFrame(before, f"_part int, _id {kind}, _tie long")
    visiting = placed.join(
        F.broadcast(wanted), F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    ).dropDuplicates(["_part"]).select("id", "text", "tie", F.col("_part").alias("part"), F.lit(1).alias("visits"))
    near = placed.withColumn("visits", F.lit(0)).unionByName(visiting).repartition("part").sortWithinPartitions(
        "part", "visits", F.col("id").desc_nulls_last(), F.col("tie").desc())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the last row so far: id, part, text, chunks
        for batch in batches:
            sizes = np.concatenate([[0], np.cumsum(
                [len(t) for t in batch.column("text").to_pylist()])]) if batch.num_rows else np.zeros(1)
            for a, b in slabs(sizes):
                some = batch.slice(a, b - a)
                texts = some.column("text").to_pylist()
                sets = _sets([t.encode() for t in texts])
                run = held + list(zip(
                    some.column("id").to_pylist(), some.column("part").to_pylist(), texts, sets,
                    some.column("visits").to_pylist()))
                held = run[-1:]
                if made := finish(run):
                    yield made

    def finish(run: list):
        pairs = [(x, y) for x, y in zip(run, run[1:]) if not x[4]]
        if not pairs:
            return None
        edited = []
        for x, y in pairs:
            k = len(x[2]) // 3
            edited.append((x[2][:len(x[2]) - k] + y[2][:k]).encode())
        sets = _sets(edited)
        return pa.RecordBatch.from_arrays([
            pa.array([x[0] for x, _ in pairs], id_type), pa.array([len(x[2]) for x, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([fingerprint(x[3]) for x, _ in pairs], pa.string()),
            pa.array([fingerprint(s) for s in sets], pa.string()),
            pa.array([likeness(x[3], s) for (x, _), s in zip(pairs, sets)], pa.float64()),
            pa.array([likeness(x[3], y[3]) for x, y in pairs], pa.float64()),
        ], ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(source.schema["id"].dataType)
    return near.select("id", "part", "text", "visits").mapInArrow(
        rows, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    ).withColumnRenamed("id", doc_id)


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited version's and the next document's."""
    return edited_by_next(table(spark, sf_dir, "documents"))
