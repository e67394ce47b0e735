"""Language identification by bit-sliced Bloom filters over byte n-grams.

Every slot of the filter holds a mask with a bit per language, so looking up an n-gram is a few
gathers whose conjunction names all languages that have it. A text's votes for a language are the
share of its n-grams with the language's bit; the share that a filter filled this much answers by
chance is taken out again:

    share = (found / n - false) / (1 - false),   false = (slots with the bit / slots) ** probes

and the language with the largest corrected share wins. N-grams are runs of bytes inside
words, the blank before and after included; A-Z and À-Þ are lower-cased, digits and signs are
blanks. The filter is fitted on at most ``SAMPLE`` texts per language and has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.registry import query, table
from quayside.llm.text import keep_rows, mix, per_row_sum, text_slabs
from quayside.session import durable

SAMPLE = 1500
SIZES = (3, 4, 5)
SLOT_BITS, PROBES = 19, 2
SLAB = 3 << 18  # bytes of text worked on at once
# An n-gram belongs to a language that has it this often per n-gram, and at least this often
# compared with the language that has it most.
RATE, RATIO = 2e-5, 0.1

_BLANK = 32
_FOLD = np.full(256, _BLANK, np.uint8)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of all n-grams and each row's first n-gram number."""
    folded = _FOLD[data]
    if len(data):
        accent = np.zeros(len(data), bool)
        accent[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        folded[accent] += 32
    # A blank before each row and behind the last, then one blank for each run of them.
    padded = np.insert(folded, offsets, _BLANK)
    bounds = offsets + np.arange(len(offsets))
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != _BLANK) | (padded[:-1] != _BLANK)
    place = np.concatenate([[0], np.cumsum(keep)])
    padded = padded[keep]
    bounds = place[bounds + 1] - 1  # each row's first blank, maybe shared with the row before
    solid = padded != _BLANK
    keys, ats = [], []
    for size in SIZES:
        count = len(padded) - size + 1
        if count <= 0:
            continue
        ok = solid[1:1 + count].copy()
        for k in range(2, size - 1):
            ok &= solid[k:k + count]
        at = np.flatnonzero(ok)
        key = np.full(len(at), size, np.uint64)
        for k in range(size):
            key = (key << np.uint64(8)) | padded[at + k]
        keys.append(key)
        ats.append(at)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.concatenate(ats)
    row = np.searchsorted(bounds[:-1], at, "right") - 1
    order = np.argsort(row, kind="stable")
    firsts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])
    return mix(np.concatenate(keys)[order]), firsts


def slots(keys: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [(keys >> np.uint64(SLOT_BITS * k) & mask).astype(np.int64) for k in range(PROBES)]


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a letter of any script."""
    found = per_row_sum(_LETTER[data], offsets) > 0
    for row in np.flatnonzero(~found & (per_row_sum(data >= 128, offsets) > 0)):
        found[row] = any(c.isalpha() for c in data[offsets[row]:offsets[row + 1]].tobytes().decode())
    return found


def learn_filter(docs: DataFrame, text: str, lang: str, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, the commonest first, and the filter: one 64-bit mask word per slot and 64
    languages. ``docs`` holds the rows to learn from and a column ``id``, whose hash picks the
    sample."""
    counts = docs.filter(F.col(lang).isNotNull()).groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()
    counts.sort(key=lambda r: (-r["n"], r[lang]))
    names = [r[lang] for r in counts]
    if not names:
        return [], np.zeros((1, 1 << SLOT_BITS), np.uint64)
    place = F.create_map(*[x for k, name in enumerate(names) for x in (F.lit(name), F.lit(k))])
    # A share of all hashes that leaves a few more texts than wanted, then the smallest of them:
    # which texts teach depends on ids and texts alone.
    bound = {r[lang]: min(int(1.5 * sample / r["n"] * 2**64), 2**64 - 1) - 2**63 for r in counts}
    most = F.create_map(*[x for name, b in bound.items() for x in (F.lit(name), F.lit(b))])
    drawn = docs.filter(F.col(lang).isNotNull()).withColumn("_hash", F.xxhash64("id", F.lit(3))).filter(
        F.col("_hash") <= most[F.col(lang)])
    first = Window.partitionBy(lang).orderBy("_hash", F.xxhash64(text), text)
    picked = drawn.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= sample).select(
        F.col(text).alias("text"), place[F.col(lang)].alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slabs(batches, "text", SLAB):
            keys, firsts = grams(data, offsets)
            lang = np.repeat(batch.column("lang").to_numpy(), np.diff(firsts)).astype(np.uint64)
            for k in np.unique(lang):
                key, n = np.unique(keys[lang == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(key), int(k), np.int32)), pa.array(n)],
                    ["gram", "lang", "n"])

    grouped = durable(picked.mapInArrow(count, "gram long, lang int, n long").groupBy("gram", "lang").agg(
        F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["n"] for r in grouped.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = F.create_map(*[x for k, n in totals.items() for x in (F.lit(k), F.lit(n))]) if totals else F.lit(None)
    rated = grouped.withColumn("rate", F.col("n") / total[F.col("lang")]).filter(
        (F.col("rate") >= RATE) & (F.col("n") >= 2))
    most = rated.groupBy("gram").agg(F.max("rate").alias("most"))
    kept = rated.join(most, "gram").filter(F.col("rate") >= F.col("most") * RATIO)
    probe = F.array(*[
        F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) for k in range(PROBES)])
    masks = kept.select(
        F.explode(probe).alias("slot"), (F.col("lang") / 64).cast("int").alias("word"),
        F.expr("shiftleft(1L, lang % 64)").alias("bit"),
    ).groupBy("slot", "word").agg(F.bit_or("bit").alias("mask"))
    table_ = np.zeros((-(-len(names) // 64), 1 << SLOT_BITS), np.uint64)
    found = masks.toArrow()  # at most a row per slot and 64 languages
    table_[found.column("word").to_numpy(), found.column("slot").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return names, table_


def votes(masks: np.ndarray, many: int, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: number of the winning language (``many``: none), score, corrected share."""
    keys, firsts = grams(data, offsets)
    n = np.maximum(np.diff(firsts), 1)
    at = slots(keys)
    shares = np.zeros((max(many, 2), len(n)))
    for word in range(len(masks)):
        both = masks[word][at[0]]
        for other in at[1:]:
            both &= masks[word][other]
        for k in range(64 * word, min(64 * word + 64, many)):
            bit = np.uint64(k % 64)
            false = float((masks[word] >> bit & np.uint64(1)).mean()) ** PROBES
            hits = per_row_sum((both >> bit & np.uint64(1)).astype(np.uint8), firsts)
            shares[k] = np.maximum(hits / n - false, 0) / (1 - false)
    ranked = np.sort(shares, 0)
    top, second = ranked[-1], ranked[-2]
    letters = has_letter(data, offsets) & (many > 0)
    score = np.where(letters & (top > 0), top / np.maximum(top + second, 1e-12), 0.0)
    return np.where(letters, shares.argmax(0), many), score, np.where(letters, top, 0.0)


def keep_languages(
    docs: DataFrame, held_out: Column, least: float = 0.05, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows, unchanged, whose text has letters and a learned language: a corrected share of at
    least ``least``. If there is no language to learn, rows with letters stay."""
    learnt = docs.filter(~F.coalesce(held_out, F.lit(False))).select(F.col(doc_id).alias("id"), text, lang)
    names, masks = learn_filter(learnt, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(masks)

    def verdict(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not names:
            return has_letter(data, offsets)
        best, _, share = votes(shared.value, len(names), data, offsets)
        return (best < len(names)) & (share >= least)

    return keep_rows(docs, text, verdict, SLAB)


def identify(
    docs: DataFrame, names: list[str], masks: np.ndarray, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, lang_pred, score, share (corrected share of the winner).

    ``und`` with score and share 0 where the text is null or has no letter. A text none of whose
    n-grams is known gets the commonest language with score 0. The score is the winner's corrected
    share over its sum with the next one's. Other columns are left out.
    """
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(masks)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slabs(batches, "text", SLAB):
            best, score, share = votes(shared.value, len(names), data, offsets)
            labels = np.array([*names, "und"], object)[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(labels, pa.string()), pa.array(score), pa.array(share)],
                ["id", "lang_pred", "score", "share"])

    return source.mapInArrow(
        rows, f"id {kind}, lang_pred string, score double, share double").withColumnRenamed("id", doc_id)


def languages(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Per row: id, held_out, lang_pred, score, share; learnt from rows that aren't held out and
    have a language. A null condition means learnt from. Repeated rows count as often as they
    occur; without any row to learn from every text is ``und``. An empty table gives no rows."""
    learnt = docs.filter(~F.coalesce(held_out, F.lit(False))).select(F.col(doc_id).alias("id"), text, lang)
    names, masks = learn_filter(learnt, text, lang)
    found = identify(docs, names, masks, doc_id, text)
    return found.select(doc_id, F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "share")


def fourth_of_ids(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


@query("op2_language_filters")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from three quarters of the ids."""
    return languages(table(spark, sf_dir, "documents"), fourth_of_ids())
