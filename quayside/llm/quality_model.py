"""Quality classifier: histogram gradient-boosted trees over statistics of the whole text.

One pass over the texts gives a short row of statistics per document; everything else works on
those. The trees are fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of the id, and
walked as flat arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import gbdt
from quayside.llm.registry import query, table
from quayside.llm.text import LOWER, binary_column, keep_rows, per_row_sum, rows_of, spans_hash, text_slabs, words
from quayside.operators.skew import lookup_join
from quayside.session import durable

SAMPLE = 20_000
# What counts as a symbol, an end of a sentence, a bracket or quote.
SYMBOLS, STOPS, MARKS = b"#*$%&|<>", b".!?", b"()[]{}\"'"
_KINDS = {
    "symbols": SYMBOLS, "bars": b"|", "shouts": b"!", "stops": STOPS, "commas": b",;:", "marks": MARKS,
    "digits": b"0123456789", "capitals": bytes(range(65, 91)), "small": bytes(range(97, 123)),
    "slashes": b"/\\_=@", "beyond": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_KINDS)), np.uint8)
for _k, _set in enumerate(_KINDS.values()):
    _TABLE[list(_set), _k] = 1


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of shares, means and logarithms per text; an empty text gives zeros."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    starts, ends, firsts = words(data, offsets)
    n, row = np.diff(firsts), rows_of(firsts)
    one_size, one_n = np.maximum(size, 1), np.maximum(n, 1)
    out = [np.log1p(n), np.log1p(size)]
    for k in range(len(_KINDS)):
        out.append(per_row_sum(_TABLE[:, k][data], offsets) / one_size)
    length = ends - starts
    out.append(per_row_sum(length, firsts) / one_n)
    out.append(per_row_sum(length <= 3, firsts) / one_n)
    out.append(per_row_sum(length >= 14, firsts) / one_n)
    last, first = data[np.maximum(ends - 1, 0)], data[starts]
    symbol = _TABLE[:, 0].astype(bool)
    out.append(per_row_sum(symbol[last] | symbol[first], firsts) / one_n)
    out.append(per_row_sum((first >= 65) & (first <= 90), firsts) / one_n)

    # Words and pairs of words that the text has had before.
    key = spans_hash(LOWER[data], starts, ends)
    for step in (0, 1):
        value = key if step == 0 else key + np.append(key[1:], 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort((value, row))
        again = np.zeros(len(value), bool)
        again[1:] = (value[order][1:] == value[order][:-1]) & (row[order][1:] == row[order][:-1])
        out.append(np.bincount(row[order][again], minlength=rows) / one_n)
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (row[1:] == row[:-1])
    out.append(np.bincount(row[same], minlength=rows) / one_n)

    # Lines: how many, how many end a sentence, how many stood in the text before.
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:] |= np.append(data == 10, False)[:len(data)] if len(data) else False
    line = np.flatnonzero(edge[:-1]) if len(data) else np.zeros(0, np.int64)
    stop = np.append(line[1:], len(data))
    line_row = np.searchsorted(offsets, line, "right") - 1
    body = np.where(data[np.maximum(stop - 1, 0)] == 10, stop - 1, stop) if len(line) else stop
    full = body > line
    ended = np.isin(data[np.maximum(body - 1, 0)], list(STOPS)) & full if len(line) else full
    lines = np.bincount(line_row[full], minlength=rows)
    out.append(np.bincount(line_row[ended], minlength=rows) / np.maximum(lines, 1))
    out.append(np.log1p(n / np.maximum(lines, 1)))
    value, at = spans_hash(data, line[full], body[full]), line_row[full]
    order = np.lexsort((value, at))
    again = np.zeros(len(value), bool)
    again[1:] = (value[order][1:] == value[order][:-1]) & (at[order][1:] == at[order][:-1])
    out.append(np.bincount(at[order][again], minlength=rows) / np.maximum(lines, 1))
    out.append(np.log1p(lines))
    return np.stack(out, 1).astype(np.float32)


def with_statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id and its statistics as packed 32-bit floats."""
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slabs(batches, "text"):
            made = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), binary_column(made.view(np.uint8).ravel(), np.arange(len(made) + 1) * made.shape[1] * 4)],
                ["id", "statistics"])

    return source.mapInArrow(rows, f"id {kind}, statistics binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in column])


def known_labels(labels: DataFrame, held_out: Column, doc_id: str, label: str) -> DataFrame:
    """One row (id, label) for every id with usable labels; of several labels the greatest counts."""
    usable = F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~F.coalesce(held_out, F.lit(False))
    return labels.filter(usable).groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))


def smallest_hashes(known: DataFrame, most: int, salt: int) -> DataFrame:
    """At most ``most`` rows, those whose ids have the smallest hashes, whatever the partitions."""
    return known.orderBy(F.xxhash64("id", F.lit(salt)), "id").limit(most)


def teach(stats: DataFrame, picked: DataFrame) -> dict[str, np.ndarray]:
    """Trees from the statistics of the picked ids (id, label). An id that several rows have teaches
    once, by the smallest of their statistics."""
    found = lookup_join(stats.filter("id IS NOT NULL"), picked, ["id"])
    taught = found.groupBy("id").agg(F.min("statistics").alias("statistics"), F.first("label").alias("label")).toArrow()
    if not taught.num_rows:
        return gbdt.fit(np.zeros((0, 1)), np.zeros(0))
    order = pc.sort_indices(taught, sort_keys=[("id", "ascending")])
    taught = taught.take(order).combine_chunks()
    y = taught.column("label").to_numpy().astype(float)
    return gbdt.fit(_matrix(taught.column("statistics").combine_chunks()), y)


def keep_quality(
    docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int = SAMPLE, at: float = 0.5,
) -> DataFrame:
    """The rows, unchanged, whose text scores ``at`` or more. Only the texts of labelled ids that
    teach are looked at twice. ``held_out`` is a condition on the id of ``labels``."""
    picked = durable(smallest_hashes(known_labels(labels, held_out, doc_id, label), sample, 7), "picked")
    some = lookup_join(
        docs.select(doc_id, text), picked.select(F.col("id").alias(doc_id)), [doc_id], "left_semi", stored=True)
    shared = docs.sparkSession.sparkContext.broadcast(teach(with_statistics(some, doc_id, text), picked))

    def verdict(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return gbdt.predict(shared.value, statistics(data, offsets)) >= at

    return keep_rows(docs, text, verdict)


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int = SAMPLE, at: float = 0.5,
) -> DataFrame:
    """Per row: id, held_out, score from 0 to 1, predicted.

    ``held_out`` is a condition on the id of ``labels`` and ``docs``; such labels are not used.
    Labels that are null, or of unknown or null ids, teach nothing; of several labels of an id the
    greatest counts, and an id teaches once however many rows have it; without usable labels of both
    classes the score is their smoothed share. A null text is scored as an empty one. Repeated
    rows give repeated rows. Other columns are left out. An empty table gives no rows.
    """
    stats = durable(with_statistics(docs, doc_id, text), "statistics")
    picked = smallest_hashes(known_labels(labels, held_out, doc_id, label), sample, 7)
    shared = docs.sparkSession.sparkContext.broadcast(teach(stats, picked))
    kind = stats.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = gbdt.predict(shared.value, _matrix(batch.column("statistics")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(score), pa.array((score >= at).astype(np.int32))],
                    ["id", "score", "predicted"])

    scored = stats.mapInArrow(rows, f"id {kind}, score double, predicted int").withColumnRenamed("id", doc_id)
    return scored.select(doc_id, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def third_of_ids(remainder: int = 1, parts: int = 3, doc_id: str = "doc_id") -> Column:
    """Ids whose CRC-32 (as text) leaves ``remainder``."""
    return F.crc32(F.col(doc_id).cast("string")) % parts == remainder


@query("op7_quality_model")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, taught by the labels of two thirds of the ids."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), third_of_ids())
