"""Filter interaction audit: what every filter removes in every order, from one count of masks.

Each document becomes a mask of the filters it fails. Per part the documents of a mask are one cell
(at most 32 cells of counts), and all orders are answered from the survivors of the 32 sets of
active filters. The sets are walked in Gray code: one filter is switched on or off at a time, every
cell that fails it moves its counter of active failures by one, and a cell whose counter leaves or
reaches zero leaves or joins the running survivors. What a step of an order removes is the
difference of two states.

Texts are judged in DataFrame functions, and only compact rows (id, part, digest, mask) are stored
and shuffled. Copies are never joined: they are counted per digest, and the first id of a digest is
a minimum, so a text that a third of all rows hold is combined in the tasks that read it.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.quality_rules import let, word_list
from quayside.llm.registry import query, table
from quayside.operators.skew import lookup_join
from quayside.session import durable

# Fixed values of the five filters.
FILTERS = "ABCDE"
WORDS_LEAST, DISTINCT_PERCENT, CAPITALS_PERCENT = 100, 80, 10
SIGNS = "[#$%&*|]"


def gray_states(masks: Sequence[int], counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors' counts for each set of active filters: a row per set, numbered by its bits.

    ``counts`` has a row per mask. Sets are visited in Gray code, one filter toggled at a time.
    """
    masks = np.asarray(masks, np.int64)
    states = np.zeros((1 << filters, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    survivors = counts.sum(0).astype(np.int64)
    active = 0
    states[0] = survivors
    for step in range(1, 1 << filters):
        bit = step & -step  # the filter that Gray code toggles in this step
        hit = masks & bit != 0
        if active & bit:
            failing[hit] -= 1
            survivors += counts[hit & (failing == 0)].sum(0)
        else:
            survivors -= counts[hit & (failing == 0)].sum(0)
            failing[hit] += 1
        active ^= bit
        states[active] = survivors
    return states


def order_rows(states: np.ndarray, names: str) -> dict[str, list]:
    """A row per order and step, from the survivors (documents, good, toxic) of every set."""
    everything = (1 << len(names)) - 1
    total = states[0, 0]
    failing = [total - states[1 << k, 0] for k in range(len(names))]
    unique = [states[everything ^ (1 << k), 0] - states[everything, 0] for k in range(len(names))]
    out: dict[str, list] = {c: [] for c in (
        "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")}
    shapley = [0] * len(names)
    for order in itertools.permutations(range(len(names))):
        active = 0
        for step, k in enumerate(order, 1):
            lost = states[active] - states[active | 1 << k]
            active |= 1 << k
            shapley[k] += lost[0]
            for name, value in zip(out, (
                "".join(names[j] for j in order), step, k, states[active, 0], lost[0], failing[k] - lost[0],
                unique[k], lost[1], lost[2],
            )):
                out[name].append(value)
    out["shapley"] = [shapley[k] for k in out.pop("filter")]
    return out


def interaction_audit(cells: DataFrame, names: str = FILTERS, part: str = "part") -> DataFrame:
    """Per part, order of ``names`` and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.

    ``cells`` has columns part, mask (bit k: fails filter k), n, good, toxic; rows of one mask add
    up. A part's group has at most one row per mask, whatever the number of documents.
    """
    combined = cells.groupBy(F.col(part).alias("part"), "mask").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])

    def walk(key: tuple, group: pa.Table) -> pa.Table:
        counts = np.stack([group.column(c).to_numpy() for c in ("n", "good", "toxic")], 1)
        rows = order_rows(gray_states(group.column("mask").to_numpy(), counts, len(names)), names)
        size = len(rows["step"])
        columns = {"part": pa.array([key[0].as_py()] * size, pa.string())}
        for name, values in rows.items():
            columns[name] = pa.array(values, pa.string() if name == "filter_order" else pa.int32() if name == "step" else pa.int64())
        return pa.table(columns)

    return combined.groupBy("part").applyInArrow(
        walk, "part string, filter_order string, step int, kept long, removed long, redundant long, "
              "unique_fails long, good_lost long, toxic_lost long, shapley long")


def failures(text: Column) -> Column:
    """The mask of the filters A to D, which look at one text alone."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))

    def of(w: Column) -> Column:
        return F.when(F.size(w) < WORDS_LEAST, 1).otherwise(0) + F.when(
            F.size(F.array_distinct(w)) * 100 < F.size(w) * DISTINCT_PERCENT, 2).otherwise(0)

    return (
        let(word_list(text), of)
        + F.when(capitals.cast("long") * 100 > F.length(text).cast("long") * CAPITALS_PERCENT, 4).otherwise(0)
        + F.when(text.rlike(SIGNS), 8).otherwise(0)
    ).cast("int")


def filter_cells(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Counts per part and mask: part, mask, n, good, toxic.

    A null text is empty, a null language the part ''. Repeated rows count as often as they occur;
    rows of one id and text are copies of none of each other, and a null id is neither smaller than
    another nor has smaller ones, so it never fails E nor makes others fail. A document is good
    (toxic) if any label row of its id says 1; null labels and ids say nothing. Texts are equal if
    their MD5 digests and lengths are. Other columns are left out.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    judged = durable(docs.select(
        F.col(doc_id).alias("_doc"), F.coalesce(F.col(lang), F.lit("")).alias("part"),
        F.unhex(F.md5(t.cast("binary"))).alias("digest"), F.length(t).alias("size"), failures(t).alias("mask"),
    ), "judged")
    marks = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_doc")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    cell = ["digest", "size", "part", "mask", "good", "toxic"]
    marked = lookup_join(judged, marks, ["_doc"], "left").fillna(False, ["good", "toxic"])
    by_id = marked.groupBy(*cell, "_doc").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.when(F.col("_doc").isNotNull(), F.struct("_doc", "n")))
    by_cell = by_id.groupBy(*cell).agg(
        F.sum("n").alias("n"), first.alias("first"),
        F.coalesce(F.sum(F.when(F.col("_doc").isNull(), F.col("n"))), F.lit(0)).alias("free"))
    # A digest has a row per part and kind of label here.
    smallest = F.min("first._doc").over(Window.partitionBy("digest", "size"))
    split = by_cell.withColumn("unique", F.col("free") + F.when(
        F.col("first._doc") == smallest, F.col("first.n")).otherwise(0))
    return split.select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), F.col("unique").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("unique")).alias("n")),
        )).alias("cell"),
    ).select(
        "part", "cell.mask", "cell.n", F.when(F.col("good"), F.col("cell.n")).otherwise(0).alias("good"),
        F.when(F.col("toxic"), F.col("cell.n")).otherwise(0).alias("toxic"))


AUDIT_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))
                     > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN d.doc_id > first THEN 16 ELSE 0 END AS mask
  FROM d JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
f(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT f1.l || f2.l || f3.l || f4.l || f5.l AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
  FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.b | f2.b | f3.b | f4.b | f5.b = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & bit = 0 AND mask & before = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM (SELECT part, filter_order, step, bit, CAST(before AS INTEGER) AS before, mask, n, good, toxic FROM cells, steps)
  GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted"""


@query("op12_filter_audit", AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, per language."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return interaction_audit(filter_cells(docs, labels))
