"""A hidden Markov language model: trained by Baum-Welch over the whole corpus, scored exactly.

A word is written in two steps. Its state emits a class: a word that makes up at least 1/``SHARE``
of the training tokens is a class of its own (fewer than ``SHARE`` of them, by arithmetic), every
other word belongs to one of ``RARE`` classes by its first and last bytes, and the end of a text
is a class. The class then emits the word by its corpus count, so that

    P(word | state) = P(class | state) * (c + 0.5) / (sum over the class of (c + 0.5) + 0.5)

with one unseen word per class. Counts, unlike classes, are not bounded: texts are read in blocks
of bounded size, each block's distinct words meet the corpus in one shuffle, and the counts come
back to their block. What is broadcast is the state model, bounded by the number of classes.

The first model comes from the corpus too: one pass counts what follows and precedes every class,
and classes with like neighbours start in one state. Baum-Welch is incremental: the training texts
are in ``PARTS`` parts by a hash, the same number at every size; after each part its expected counts
replace those it had, and the model is estimated anew from the sum over all parts. A sweep thus
takes counts from every training text and improves the model ``PARTS`` times; sweeps go on until
the likelihood of the training tokens settles. Counts are added up over partitions.

For training, texts are cut into runs of ``RUN`` tokens that are worked off side by side. A run is
read with ``OVERLAP`` tokens of its text on both sides, which bring both messages to the state they
would have and are not counted; the transition at a cut counts once, in the later run. Scores use
the scaled forward recursion over whole texts, without cuts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.registry import query, table
from quayside.llm.text import LOWER, binary_column, per_row_sum, slabs, spans_hash, text_slabs, words
from quayside.session import durable, scratch_path

STATES = 16
SHARE = 20_000
RARE = 4096
BLOCK_BYTES = 16 << 20
RUN = 512
OVERLAP = 16
PARTS = 8
SWEEPS = 3
SETTLED = 1e-3  # a gain per token and sweep (natural log) that ends the search
NEIGHBOURS = 128  # kinds of neighbours told apart for the first model


@dataclass
class Model:
    """Start, transitions between and class emissions of the states, and each class's size."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # classes x states

    @staticmethod
    def begin(classes: np.ndarray, states: int = STATES) -> Model:
        rng = np.random.Generator(np.random.PCG64(11))
        share = (classes + 0.5) / (classes + 0.5).sum()
        emit = share[:, None] * rng.uniform(0.5, 1.5, (len(share), states))
        move = rng.uniform(0.5, 1.5, (states, states)) + 4 * np.eye(states)
        return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def learn(self, counts: np.ndarray, classes: np.ndarray) -> Model:
        """The next model from expected counts (start, moves, emissions, one row each)."""
        k = len(self.start)
        start, move, emit = counts[0] + 0.1, counts[1:k + 1] + 0.1, counts[k + 1:]
        share = (classes + 0.5) / (classes + 0.5).sum()
        emit = emit + share[:, None]
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def first_model(classes: np.ndarray, neighbours: np.ndarray, kind: np.ndarray, states: int = STATES) -> Model:
    """A model whose states are clusters of classes with like neighbours.

    ``neighbours`` counts per class what kind of class follows (first half) and precedes it; ``kind``
    is the kind of each class: one for each of the most frequent classes, one for all others.
    """
    kinds = neighbours.shape[1] // 2
    weight = classes + 0.5
    usual = np.bincount(kind, weight, kinds) / weight.sum()
    halves = [neighbours[:, :kinds], neighbours[:, kinds:]]
    x = np.sqrt(np.concatenate([(h + 5 * usual) / (h.sum(1, keepdims=True) + 5) for h in halves], 1))
    norm = (x**2).sum(1)

    def distances(centres: np.ndarray) -> np.ndarray:
        return np.maximum(norm[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0)

    # The heaviest class, then always the one that is farthest from all centres for its weight.
    picked = [int(weight.argmax())]
    for _ in range(states - 1):
        picked.append(int((distances(x[picked]).min(1) * weight).argmax()))
    centres = x[picked]
    for _ in range(20):
        state = distances(centres).argmin(1)
        size = np.bincount(state, weight, states)
        total = np.zeros_like(centres)
        np.add.at(total, state, x * weight[:, None])
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], centres)
    far = distances(centres)
    near = far.min(1)
    share = np.exp(-(far - near[:, None]) / (np.average(near, weights=weight) + 1e-9))
    share /= share.sum(1, keepdims=True)
    emit = weight[:, None] * share
    # From a state to the kinds that follow its classes, and from a kind to the states of its classes.
    follows = np.zeros((states, kinds))
    np.add.at(follows, state, halves[0])
    of_kind = np.zeros((kinds, states))
    np.add.at(of_kind, (kind, state), weight)
    move = follows @ (of_kind / np.maximum(of_kind.sum(1, keepdims=True), 1e-300)) + 1
    start = emit.sum(0)
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def expected_counts(model: Model, classes: np.ndarray, firsts: np.ndarray, into: np.ndarray) -> float:
    """Forward and backward over the texts ``classes[firsts[i]:firsts[i + 1]]``, cut into runs that
    overlap; adds expected starts, moves and emissions to ``into`` and returns the log likelihood."""
    k = len(model.start)
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    level = np.linalg.matrix_power(model.move, 64)[0].astype(np.float32)
    length = np.diff(firsts)
    per = np.maximum(-(-length // RUN), 1)
    text = np.repeat(np.arange(len(length)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    core = firsts[:-1][text] + nth * RUN
    stop = np.minimum(core + RUN, firsts[1:][text])
    begin = np.maximum(core - OVERLAP, firsts[:-1][text])
    size = np.minimum(stop + OVERLAP, firsts[1:][text]) - begin
    order = np.argsort(-size, kind="stable")
    begin, size, head = begin[order], size[order], nth[order] == 0
    first, last = core[order] - begin, stop[order] - begin  # steps that count
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")  # runs longer than t
    alphas, total = [], 0.0
    a = np.where(head[:, None], model.start.astype(np.float32), level)
    for t in range(steps):
        n = active[t]
        a = a[:n] if t == 0 else a[:n] @ move
        a = a * emit[classes[begin[:n] + t]]
        scale = np.maximum(a.sum(1, keepdims=True), 1e-30)
        total += float(np.log(scale[(first[:n] <= t) & (t < last[:n])]).sum())
        a /= scale
        alphas.append(a)
    b = np.ones((0, k), np.float32)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if len(b) < n:
            b = np.concatenate([b, np.ones((n - len(b), k), np.float32)])
        counts = ((first[:n] <= t) & (t < last[:n]))[:, None]
        gamma = alphas[t] * b
        gamma /= np.maximum(gamma.sum(1, keepdims=True), 1e-30)
        gamma *= counts
        if t == 0:
            into[0] += gamma[head[:n]].sum(0)
        if t:
            seen = emit[classes[begin[:n] + t]] * b
            seen /= np.maximum(seen.max(1, keepdims=True), 1e-30)
            b = seen @ move.T
            before = alphas[t - 1][:n]
            seen /= np.maximum((before * b).sum(1, keepdims=True), 1e-30)
            into[1:k + 1] += (before.T @ (seen * counts)) * move
            b /= b.sum(1, keepdims=True)
        alphas[t] = gamma
    # Emissions: every (token, state) share once, token order as in the steps; shares of tokens that
    # another run counts are zero.
    if steps:
        cls = np.concatenate([classes[begin[:active[t]] + t] for t in range(steps)]).astype(np.int64)
        gammas = np.concatenate(alphas)
        for j in range(k):
            into[k + 1:, j] += np.bincount(cls, gammas[:, j], minlength=len(model.emit))
    return total


def forward(model: Model, classes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Natural log of each class sequence's probability; scaled, over whole texts."""
    length = np.diff(firsts)
    order = np.argsort(-length, kind="stable")
    begin, size = firsts[:-1][order], length[order]
    total = np.zeros(len(size))
    a = np.tile(model.start, (len(size), 1))
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")
    for t in range(steps):
        n = active[t]
        a = (a[:n] @ model.move if t else a[:n]) * model.emit[classes[begin[:n] + t]]
        s = a.sum(1)
        total[:n] += np.log(s)
        a /= s[:, None]
    out = np.empty(len(size))
    out[order] = total
    return out


def _rare_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First and up to three last bytes of a word, hashed to RARE classes."""
    last = np.maximum(ends - 1, starts)
    parts = (data[starts], data[last], data[np.maximum(last - 1, starts)], data[np.maximum(last - 2, starts)])
    key = np.zeros(len(starts), np.uint64)
    for p in parts:
        key = key * np.uint64(257) + p.astype(np.uint64)
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int32) % RARE


def _blocks(docs: DataFrame, doc_id: str, text: str, held_out: Column) -> DataFrame:
    """Texts as word numbers of their block, and the block's distinct words with counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import random

        held = []
        size = 0
        for batch, data, offsets in text_slabs(batches, "text"):
            data = LOWER[data]
            starts, ends, firsts = words(data, offsets)
            held.append((batch, spans_hash(data, starts, ends), _rare_class(data, starts, ends), firsts))
            size += len(data)
            if size >= BLOCK_BYTES:
                yield from block(held, random.getrandbits(62))
                held, size = [], 0
        if held:
            yield from block(held, random.getrandbits(62))

    def block(held, number: int) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([h for _, h, _, _ in held])
        uniq, first, ids = np.unique(keys, return_index=True, return_inverse=True)
        rare = np.concatenate([r for _, _, r, _ in held])[first]
        # Frequent words get small numbers, which store better.
        by_count = np.argsort(-np.bincount(ids, minlength=len(uniq)), kind="stable")
        place = np.empty(len(uniq), np.int32)
        place[by_count] = np.arange(len(uniq), dtype=np.int32)
        uniq, rare, ids = uniq[by_count], rare[by_count], place[ids]
        trained = np.zeros(len(uniq), np.int64)
        done = 0
        for batch, h, _, firsts in held:
            own = ids[done:done + len(h)]
            done += len(h)
            learns = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), np.diff(firsts))
            trained += np.bincount(own[learns], minlength=len(uniq))
            yield rows(number, batch, binary_column(own.view(np.uint8), firsts * 4), np.diff(firsts), batch.num_rows)
        for a in range(0, len(uniq), 1 << 16):
            b = slice(a, a + (1 << 16))
            packed = np.stack([uniq[b].view(np.int64), trained[b], rare[b].astype(np.int64), np.arange(len(uniq))[b]])
            yield rows(number, None, pa.array([packed.tobytes()], pa.binary()), np.array([0]), 1)

    def rows(number, batch, content, n, count):
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(count, number)), pa.array(np.full(count, batch is not None)),
            batch.column("id") if batch else pa.nulls(count, kind),
            batch.column("held_out") if batch else pa.nulls(count, pa.bool_()),
            pa.array(n.astype(np.int64)), content,
        ], ["block", "is_text", "id", "held_out", "n", "content"])

    from pyspark.sql.pandas.types import to_arrow_type

    source = docs.select(F.col(doc_id).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    kind = to_arrow_type(source.schema["id"].dataType)
    shape = f"block long, is_text boolean, id {source.schema['id'].dataType.simpleString()}, held_out boolean, n long, content binary"
    return source.mapInArrow(cut, shape)


def _vocabulary(blocks: DataFrame) -> DataFrame:
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column("block").to_pylist(), batch.column("content")):
                word, count, rare, place = np.frombuffer(content.as_buffer(), np.int64).reshape(4, -1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(word), pa.array(np.full(len(word), number)), pa.array(place.astype(np.int32)),
                    pa.array(rare.astype(np.int32)), pa.array(count),
                ], ["word", "block", "place", "rare", "count"])

    return blocks.filter("not is_text").select("block", "content").mapInArrow(
        explode, "word long, block long, place int, rare int, count long")


def _classed(blocks: DataFrame, counted: DataFrame, top: np.ndarray, weight: np.ndarray) -> DataFrame:
    """Per text: class sequence with the end, sums of log10(c + 0.5) and of the same relative to
    the class, and how many of its tokens training has seen."""
    kind = blocks.schema["id"].dataType.simpleString()
    share = blocks.sparkSession.sparkContext.broadcast((top, weight))

    def join(texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
        top, weight = share.value
        texts, vocabulary = texts.combine_chunks(), vocabulary.combine_chunks()
        place = vocabulary.column("place").to_numpy()
        size = len(place)
        c = np.zeros(size, np.int64)
        c[place] = vocabulary.column("count").to_numpy()
        cls = np.zeros(size, np.int64)
        word = pc.fill_null(vocabulary.column("top"), 0).to_numpy()  # by way of floats they would change
        frequent = vocabulary.column("top").is_valid().to_numpy()
        cls[place] = np.where(frequent, 1 + np.searchsorted(top, word), 1 + len(top) + vocabulary.column("rare").to_numpy())
        logs = np.log10(c + 0.5)
        inner = logs - np.log10(weight[cls])
        n = texts.column("n").to_numpy()
        firsts = np.concatenate([[0], np.cumsum(n)])
        ids = np.concatenate([np.frombuffer(v.as_buffer(), np.int32) for v in texts.column("content")] or [np.zeros(0, np.int32)])
        ends = firsts + np.arange(len(firsts))
        classes = np.zeros(ends[-1], np.uint16)
        inside = np.ones(ends[-1], bool)
        inside[ends[1:] - 1] = False
        classes[inside] = cls[ids]
        return pa.table({
            "id": texts.column("id"), "held_out": texts.column("held_out"), "n": pa.array(n),
            "known": pa.array(per_row_sum((c > 0)[ids].astype(np.int64), firsts)),
            "logs": pa.array(per_row_sum(logs[ids], firsts)), "inner": pa.array(per_row_sum(inner[ids], firsts)),
            "classes": binary_column(classes.view(np.uint8), ends * 2),
        })

    texts = blocks.filter("is_text").select("block", "id", "held_out", "n", "content")
    return texts.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        join, f"id {kind}, held_out boolean, n long, known long, logs double, inner double, classes binary")


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("classes")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), np.uint16).astype(np.int64), (offsets - offsets[0]) // 2


def _neighbours(training: DataFrame, kind: np.ndarray, kinds: int) -> np.ndarray:
    """Per class, how often each kind of class follows and precedes it in a training text; a row per
    class and kind that a task has met is shuffled."""
    shared = training.sparkSession.sparkContext.broadcast(kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = shared.value
        total = np.zeros(len(kind) * 2 * kinds, np.int32)
        for batch in batches:
            if batch.num_rows:
                classes, firsts = _sequences(batch)
                inside = np.ones(len(classes), bool)
                inside[firsts[1:-1][np.diff(firsts)[1:] > 0]] = False  # nothing precedes a text's first class
                at = np.flatnonzero(inside[1:])
                one, two = classes[at], classes[at + 1]
                for cell in (one * 2 * kinds + kind[two], two * 2 * kinds + kinds + kind[one]):
                    total += np.bincount(cell, minlength=len(total)).astype(np.int32)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell].astype(np.int64))], ["cell", "n"])

    counted = training.select("classes").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(len(kind) * 2 * kinds, np.float32)
    got = counted.toArrow()  # at most a row per class and kind: both bounded, whatever the corpus
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(len(kind), -1)


def _gather(training: DataFrame, model: Model) -> tuple[np.ndarray, float]:
    """Expected counts and log likelihood over training texts: one array per task, added up in two
    levels."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast((model.start, model.move, model.emit))
    shape = (2 + len(model.start) + len(model.emit), len(model.start))  # the last row: log likelihood
    pieces = 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import random

        into = np.zeros(shape)
        model = Model(*shared.value)
        for batch in batches:
            if batch.num_rows:
                classes, firsts = _sequences(batch)
                for a, b in slabs(firsts, 200_000):
                    into[-1, 0] += expected_counts(
                        model, classes[firsts[a]:firsts[b]], firsts[a:b + 1] - firsts[a], into[:-1])
        lane = random.randrange(64)
        for k, part in enumerate(np.array_split(into.ravel(), pieces)):
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array([k], pa.int32()), "lane": pa.array([lane], pa.int32()),
                "counts": pa.array([part.astype(np.float32).tobytes()], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer(), np.float32).astype(np.float64) for v in group.column("counts"))
        return pa.table({
            "piece": pa.array([key[0].as_py()], pa.int32()), "lane": pa.array([0], pa.int32()),
            "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    columns = "piece int, lane int, counts binary"
    counted = training.select("classes").mapInArrow(count, columns)
    rows = counted.groupBy("piece", "lane").applyInArrow(add, columns).groupBy("piece").applyInArrow(add, columns).collect()
    parts = np.array_split(np.zeros(shape).ravel(), pieces)
    for r in rows:
        parts[r["piece"]] = np.frombuffer(bytes(r["counts"]), np.float32).astype(np.float64)
    whole = np.concatenate(parts).reshape(shape)
    return whole[:-1], float(whole[-1, 0])


def train(training: DataFrame, classes: np.ndarray, tokens: int, sweeps: int = SWEEPS) -> Model:
    """The model that incremental Baum-Welch reaches from the corpus' own start; ``training`` is stored
    by its parts."""
    often = np.argsort(-classes, kind="stable")[:NEIGHBOURS - 1]
    kind = np.full(len(classes), NEIGHBOURS - 1, np.int64)
    kind[often] = np.arange(len(often))
    model = first_model(classes, _neighbours(training, kind, NEIGHBOURS), kind)
    held: list[np.ndarray | None] = [None] * PARTS
    last = -np.inf
    for _ in range(sweeps):
        now = 0.0
        for p in range(PARTS):
            held[p], found = _gather(training.filter(F.col("part") == p), model)
            now += found
            model = model.learn(sum(c for c in held if c is not None), classes)
        if now - last < SETTLED * tokens:
            break
        last = now
    return model


def score_texts(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", sweeps: int = SWEEPS
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``held_out`` rows are scored but not learnt from; null there means learnt from. A null or blank
    text is its end token alone. Repeated rows are learnt and scored as often as they occur. Other
    columns are left out. Without training texts every class is equally unlikely and the base
    gives each token probability 1. An empty table gives no rows. Training ends when the likelihood
    settles, after ``sweeps`` sweeps over all training texts at the latest.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "blocks")
    made = _blocks(docs, doc_id, text, F.coalesce(held_out, F.lit(False)))
    made.write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(made.schema).parquet(path)
    sums = blocks.filter("is_text and not held_out").agg(
        F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    ends, tokens = sums["texts"], sums["texts"] + sums["words"]

    by_word = Window.partitionBy("word")
    met = _vocabulary(blocks).select(
        "word", "block", "place", "rare", F.sum("count").over(by_word).alias("count"),
        F.min("block").over(by_word).alias("_first"))
    lead = (F.col("block") == F.col("_first")) & (F.col("count") > 0)
    counted = durable(met.select(
        "block", "place", "rare", "count", lead.alias("lead"),
        F.when((F.col("count") * SHARE >= tokens) & (F.col("count") > 0), F.col("word")).alias("top"),
    ), "counts")
    # Fewer than SHARE frequent words and RARE classes: both bounded, whatever the corpus.
    frequent = counted.filter("lead and top is not null").select("top", "count").collect()
    rare = counted.filter("lead and top is null").groupBy("rare").agg(
        F.count(F.lit(1)).alias("words"), F.sum("count").alias("count")).collect()
    distinct = len(frequent) + sum(r["words"] for r in rare) + (ends > 0)
    frequent.sort(key=lambda r: r["top"])
    top = np.array([r["top"] for r in frequent], np.int64)
    classes = np.zeros(1 + len(top) + RARE)
    weight = np.ones(len(classes))  # what (c + 0.5) of a word is divided by
    classes[0] = ends
    classes[1:1 + len(top)] = [r["count"] for r in frequent]
    weight[1:1 + len(top)] = classes[1:1 + len(top)] + 0.5
    weight[1 + len(top):] = 0.5
    for r in rare:
        classes[1 + len(top) + r["rare"]] = r["count"]
        weight[1 + len(top) + r["rare"]] = r["count"] + 0.5 * r["words"] + 0.5

    made = _classed(blocks, counted, top, weight)
    path = scratch_path(spark, "classes")
    part = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("id", "n", "logs"), F.lit(PARTS))).cast("int")
    made.withColumn("part", part).write.option("compression", "zstd").partitionBy("part").parquet(path)
    classed = spark.read.schema(f"{made._jdf.schema().toDDL()}, part int").parquet(path)
    if ends:
        model = train(classed.filter("part >= 0"), classes, tokens, sweeps)
    else:
        model = Model.begin(classes)

    shared = spark.sparkContext.broadcast((model.start, model.move, model.emit))
    kind = classed.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            seq, firsts = _sequences(batch)
            logs = [forward(model, seq[firsts[a]:firsts[b]], firsts[a:b + 1] - firsts[a])
                    for a, b in slabs(firsts, 2_000_000)]
            n = batch.column("n").to_numpy() + 1
            base = batch.column("logs").to_numpy() + np.log10(ends + 0.5) - n * np.log10(tokens + 0.5 * (distinct + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("held_out"), pa.array(n),
                pa.array(batch.column("known").to_numpy() + int(ends > 0)),
                pa.array(np.full(len(n), tokens, np.int64)), pa.array(base),
                pa.array(np.concatenate(logs) / np.log(10) + batch.column("inner").to_numpy()),
            ], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    shape = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return classed.select("id", "held_out", "n", "known", "logs", "inner", "classes").mapInArrow(score, shape).withColumnRenamed("id", doc_id)


@query("op10_hmm_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of those whose id's CRC leaves no 1 modulo 5."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return score_texts(table(spark, sf_dir, "documents"), held_out)
