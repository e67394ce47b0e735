"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear support vector machine.

Two words are alike in the kernel when they share subsequences of ``LENGTH`` letters, which may
have up to ``GAPS`` other letters between each two; every letter passed over costs a factor
``DECAY``. So an insult with a letter put in, or with an ending of another word, stays close to
itself. The kernel is normalised and squared, and a word is described by its kernel values against a
few landmark words, turned by the inverse root of the landmarks' own kernel matrix (Nystroem): in
that space the support vector machine is linear. A word that is below ``LEAST_VALUE`` against every
landmark counts as like none, which most words are; a bound tells without their kernel values.

The machine learns from sentences: a sentence of a toxic document is taken to hold a toxic word,
one of any other document holds none. Which word that is, is found in turns: train, then take the
worst word of each sentence, train again. All toxic texts and some others teach a second time with a
letter put into each of their longer words. A document's score is a logistic function of its two
worst sentences and the number and share of its bad words.

Words are runs between white space, in lower case, with accents kept apart, digits read as the
letters they stand for, signs dropped, and neighbouring single letters taken together.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.quality_model import known_labels, smallest_hashes, third_of_ids
from quayside.llm.registry import query, table
from quayside.llm.text import per_row_sum, rows_of, slabs, spans_hash, text_slabs, utf8, words
from quayside.operators.skew import lookup_join

TOXIC_TEXTS, CLEAN_TEXTS, TEXT_CHARS = 1500, 3000, 20_000
LENGTH, GAPS, DECAY = 4, 2, 0.8
LEAST_VALUE = 0.35  # before the square
DISGUISED = 600  # clean texts that teach in disguise too
LANDMARKS, CLEAN_LANDMARKS = 64, 32
TURNS = 4
KNOWN_WORDS = 400_000

_HEAD, _TAIL = 61, 62
_CODE = np.zeros(256, np.uint8)  # 0: dropped
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
for _digit, _letter in zip(b"013457", b"oieast"):  # fixed values: digits read as letters
    _CODE[_digit] = _letter - 96
_CODE[0x80:0xC0] = 27 + np.arange(64) % 32  # second bytes; upper and lower case meet


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words with head and tail marks, each word's first code, its row and sentence.

    A sentence ends with a word whose last byte is one of . ! ? and at the end of a line."""
    starts, ends, firsts = words(data, offsets)
    row = rows_of(firsts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), none, none
    newlines = np.concatenate([[0], np.cumsum(data == 10)])
    stops = np.isin(data[ends - 1], list(b".!?"))
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (newlines[starts[1:]] > newlines[starts[:-1]]) | stops[:-1]
    single = ends - starts == 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & ~fresh[1:]
    unit = np.cumsum(~joined) - 1
    sentence = (np.cumsum(fresh) - 1)[~joined]
    # Codes of the bytes inside words, in order, then marks around each unit.
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    code = _CODE[data]
    at = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & (code > 0))
    owner = unit[np.searchsorted(starts, at, "right") - 1]
    count = np.bincount(owner, minlength=unit[-1] + 1)
    first = np.concatenate([[0], np.cumsum(count + 2)])
    out = np.zeros(first[-1], np.uint8)
    out[first[:-1]] = _HEAD
    out[first[1:] - 1] = _TAIL
    out[np.arange(len(at)) + 2 * owner + 1] = code[at]
    return out, first, row[~joined], sentence


# Places of the letters of a subsequence after its first one, and what its gaps cost.
PATTERNS = [
    (tuple(np.cumsum(np.array(gaps) + 1).tolist()), DECAY ** sum(gaps))
    for gaps in itertools.product(range(GAPS + 1), repeat=LENGTH - 1)
]


def _keys(codes: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """The subsequence that starts at each code, as a number; the last codes have none."""
    size = max(len(codes) - places[-1], 0)
    key = codes[:size].astype(np.int32)
    for p in places:
        key = key * 64 + codes[p:p + size]
    return key


def _left(first: np.ndarray) -> np.ndarray:
    """How many codes a word has from each of its codes on, itself included."""
    return np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])


def subsequences(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence as a number, weight) of all words."""
    word, left = rows_of(first), _left(first)
    found = []
    for places, weight in PATTERNS:
        key = _keys(codes, places)
        at = np.flatnonzero(left[:len(key)] > places[-1])
        found.append((word[at], key[at], np.full(len(at), weight, np.float32)))
    return tuple(np.concatenate(x) for x in zip(*found))


class Kernel:
    """Kernel values of words against the landmarks."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        word, key, weight = subsequences(codes, first)
        self.keys = np.unique(key)
        size = len(first) - 1
        self.table = np.zeros((len(self.keys), size), np.float32)
        np.add.at(self.table, (np.searchsorted(self.keys, key), word), weight)
        self.table /= np.maximum(np.sqrt((self.table**2).sum(0)), 1e-9)
        self.ready()

    def ready(self) -> None:
        """What the values need beside the table: each key's greatest entry, by key, and 0 for others."""
        self.most = np.zeros(64**LENGTH, np.float32)
        self.most[self.keys] = self.table.max(1, initial=0)

    def values(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Normalised and squared values; those of words below the least value are 0."""
        size = len(first) - 1
        out = np.zeros((size, self.table.shape[1]), np.float32)
        if not len(self.keys) or not len(codes):
            return out
        # No value of a word is above this bound over its norm, and the norm is not below the one
        # that takes every subsequence as a different one.
        left, length = _left(first), np.diff(first)
        bound, least = np.zeros(len(codes), np.float32), np.zeros(size)
        for places, weight in PATTERNS:
            key = _keys(codes, places)
            bound[:len(key)] += np.where(left[:len(key)] > places[-1], self.most[key], 0) * np.float32(weight)
            least += weight**2 * np.maximum(length - places[-1], 0)
        near = np.flatnonzero(per_row_sum(bound, first) >= LEAST_VALUE * np.sqrt(least) * (1 - 1e-4))
        near = near[least[near] > 0]
        for a in range(0, len(near), 2000):
            self._exact(near[a:a + 2000], codes, first, out)
        return out

    def _exact(self, which: np.ndarray, codes: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
        some = _pick(codes, first, which)
        word, key, weight = subsequences(*some)
        order = np.argsort(word * 64**LENGTH + key, kind="stable")
        word, key, weight = word[order], key[order], weight[order]
        at = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (key[1:] != key[:-1])))
        word, key, weight = word[at], key[at], np.add.reduceat(weight, at)
        norm = np.sqrt(np.bincount(word, weight.astype(np.float64) ** 2, len(which)))
        hit = np.flatnonzero(self.most[key] > 0)
        bound = np.bincount(word[hit], weight[hit] * self.most[key[hit]], len(which))
        hit = hit[(bound >= LEAST_VALUE * norm)[word[hit]]]
        if len(hit):
            who = word[hit]
            begin = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            place = np.searchsorted(self.keys, key[hit])
            sums = np.add.reduceat(self.table[place] * weight[hit, None], begin, axis=0)
            out[which[who[begin]]] = (sums / norm[who[begin], None]) ** 2


def disguised(text: str, rng: np.random.Generator) -> str:
    """The text with a letter put into each word of four letters or more."""

    def change(m: re.Match) -> str:
        word = m.group()
        at = int(rng.integers(1, len(word) - 1))
        return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]

    return re.sub(r"[^\s]{4,}", change, text)


def _distinct(codes: np.ndarray, first: np.ndarray):
    """(hash of each word, one word number per distinct hash, each word's distinct number)."""
    key = spans_hash(codes, first[:-1], first[1:])
    uniq, one, back = np.unique(key, return_index=True, return_inverse=True)
    return uniq, one, back


def _pick(codes: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the words ``which``."""
    size = (first[1:] - first[:-1])[which]
    start = np.concatenate([[0], np.cumsum(size)])
    row = rows_of(start)
    return codes[np.arange(start[-1]) - start[row] + first[which][row]], start


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    sign, w = 2 * y - 1, np.zeros(x.shape[1])
    penalty = ridge * weight.sum() * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(30):
        inside = sign * (x @ w) < 1
        xi, wi = x[inside], weight[inside]
        new = np.linalg.solve(xi.T @ (xi * wi[:, None]) + penalty, xi.T @ (wi * sign[inside]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-2 * np.eye(len(w)),
                               x.T @ (y - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _summary(value: np.ndarray, row: np.ndarray, sentence: np.ndarray, rows: int) -> np.ndarray:
    """Per row: its two worst sentences (their worst word), log number and share of bad words."""
    out = np.zeros((rows, 4))
    out[:, :2] = -2.0
    if len(value):
        begin = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
        worst, of = np.maximum.reduceat(value, begin), row[begin]
        order = np.lexsort((worst, of))
        worst, of = np.maximum(worst[order], -2.0), of[order]
        last = np.flatnonzero(np.append(of[1:] != of[:-1], True))
        out[of[last], 0] = worst[last]
        more = last[(last > 0) & (of[np.maximum(last - 1, 0)] == of[last])]
        out[of[more], 1] = worst[more - 1]
        bad = np.bincount(row, value > 0, rows)
        out[:, 2], out[:, 3] = np.log1p(bad), np.sqrt(bad / np.maximum(np.bincount(row, minlength=rows), 1))
    return out


def _vocabulary(texts: Iterator[str]) -> tuple[np.ndarray, ...]:
    """Codes of all distinct words with each one's first code, and per word of the texts: its distinct
    word, row and sentence. Texts are read in slabs, so memory follows the words, not the bytes."""
    known, codes, sizes = np.zeros(0, np.uint64), [], []
    keys, rows, sentences, seen = [], [], [], [0, 0]
    while part := list(itertools.islice(texts, 200)):
        data, offsets = utf8(pa.array(part, pa.large_string()))
        for a, b in slabs(offsets, 1 << 20):
            some, first, row, sentence = units(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            uniq, one, back = _distinct(some, first)
            new = ~np.isin(uniq, known)
            picked, starts = _pick(some, first, one[new])
            codes.append(picked)
            sizes.append(np.diff(starts))
            known = np.concatenate([known, uniq[new]])
            keys.append(uniq[back])
            rows.append((row + seen[0] + a).astype(np.int32))
            sentences.append((sentence + seen[1]).astype(np.int32))
            seen[1] += int(sentence[-1]) + 1 if len(sentence) else 0
        seen[0] += len(part)
    order = np.argsort(known)
    first = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))])
    codes, first = _pick(np.concatenate([*codes, np.zeros(0, np.uint8)]), first, order)
    back = np.searchsorted(known[order], np.concatenate([*keys, np.zeros(0, np.uint64)])).astype(np.int32)
    return codes, first, back, *(np.concatenate([*x, np.zeros(0, np.int32)]) for x in (rows, sentences))


def _alike(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Squared kernel values of some words against each other, a block of subsequences at a time."""
    size = len(first) - 1
    word, key, weight = subsequences(codes, first)
    order = np.argsort(key, kind="stable")
    word, key, weight = word[order], key[order], weight[order]
    place = np.cumsum(np.append(False, key[1:] != key[:-1])) if len(key) else key
    gram = np.zeros((size, size))
    for a in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        x, y = np.searchsorted(place, [a, a + 4096])
        block = np.zeros((4096, size), np.float32)
        np.add.at(block, (place[x:y] - a, word[x:y]), weight[x:y])
        gram += block.T @ block
    norm = np.maximum(np.sqrt(gram.diagonal()), 1e-9)
    return (gram / norm / norm[:, None]) ** 2


def learn(texts: list[str], toxic: np.ndarray) -> dict | None:
    """Landmarks, machine and calibration from texts marked 0 or 1; None without both classes."""
    if len(texts) == 0 or toxic.min() == toxic.max():
        return None
    rng = np.random.Generator(np.random.PCG64(19))
    again = [*np.flatnonzero(toxic == 1), *np.flatnonzero(toxic == 0)[:DISGUISED]]
    codes, first, back, row, sentence = _vocabulary(itertools.chain(texts, (disguised(texts[k], rng) for k in again)))
    toxic, size = np.concatenate([toxic, toxic[again]]), len(texts) + len(again)
    if not len(back):
        return None
    # In how many toxic and other texts each distinct word stands.
    one = np.arange(len(first) - 1)
    pair = np.unique(back.astype(np.int64) * size + row)
    bad = np.bincount(pair // size, toxic[pair % size], len(one))
    good = np.bincount(pair // size, 1 - toxic[pair % size], len(one))
    texts_bad, texts_good = toxic.sum(), (1 - toxic).sum()
    ratio = np.log((bad + 0.1) / texts_bad) - np.log((good + 0.1) / texts_good)
    long = np.diff(first) >= LENGTH + 1
    linked = np.where(long & (ratio > np.log(4)), bad * ratio, 0)
    ranked = np.argsort(-linked)[:8 * LANDMARKS]
    ranked = ranked[linked[ranked] > 0]
    if not len(ranked):
        return None
    near = _alike(*_pick(codes, first, ranked))
    chosen: list[int] = []
    for k in range(len(ranked)):
        if len(chosen) < LANDMARKS and (not chosen or near[k, chosen].max() < 0.8):
            chosen.append(k)
    usual = np.argsort(-np.where(long & (ratio < 0), good, 0))[:CLEAN_LANDMARKS]
    marks = _pick(codes, first, np.concatenate([ranked[chosen], usual]))
    kernel = Kernel(*marks)
    own = kernel.values(*marks).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    turn = vectors / np.sqrt(np.maximum(values, 1e-3))
    # Only words near a landmark have a row of their own; row 0 stands for all others.
    rows, near_some = [np.zeros((1, len(turn)))], np.zeros(len(one), np.int64)
    for a in range(0, len(one), 20_000):
        made = kernel.values(*_pick(codes, first, one[a:a + 20_000]))
        some = np.flatnonzero(made.any(1))
        near_some[a + some] = sum(map(len, rows)) + np.arange(len(some))
        rows.append(made[some] @ turn)
    z, rows = np.concatenate(rows), []
    begin = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
    label = toxic[row[begin]].astype(float)
    value = np.where(linked > 0, ratio, -1.0)  # the first guess at the worst words
    for _ in range(TURNS):
        score = value[back]
        order = np.lexsort((score, sentence))
        worst = back[order[np.append(begin[1:], len(sentence)) - 1]]
        # A toxic document has toxic sentences, but not all are: its sentences with a word the
        # machine (or the first guess) holds bad, and its worst sentence at least.
        top = np.lexsort((value[worst], row[begin]))
        worst_of_row = top[np.append(row[begin][top][1:] != row[begin][top][:-1], True)]
        positive = (label == 1) & (value[worst] > 0)
        positive[worst_of_row[label[worst_of_row] == 1]] = True
        # Words that are like none share a row, so it teaches once with the weight of all of them.
        often = np.bincount(near_some[worst[label == 0]], minlength=len(z))
        count = np.bincount(near_some[worst[positive]], minlength=len(z))
        plus, negative = np.flatnonzero(count), np.flatnonzero(often)
        y = np.concatenate([np.ones(len(plus)), np.zeros(len(negative))])
        w = np.concatenate([count[plus] / count.sum(), often[negative] / often.sum()]) * len(y) / 2
        machine = _svm(z[np.concatenate([plus, negative])], y, w)
        value = (z @ machine[:-1] + machine[-1])[near_some]
    fold = turn @ machine[:-1]
    summary = _summary(value[back], row, sentence, size)
    return {"keys": kernel.keys, "table": kernel.table, "fold": fold, "bias": machine[-1],
            "logistic": _logistic(summary, toxic.astype(float))}


class Scorer:
    """Scores of texts; remembers the values of words, at most ``KNOWN_WORDS`` at a time."""

    def __init__(self, model: dict):
        self.model = model
        self.kernel = Kernel.__new__(Kernel)
        self.kernel.keys, self.kernel.table = model["keys"], model["table"]
        self.kernel.ready()
        self.known = np.zeros(0, np.uint64)
        self.value = np.zeros(0)

    def words(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        uniq, one, back = _distinct(codes, first)
        at = np.minimum(np.searchsorted(self.known, uniq), max(len(self.known) - 1, 0))
        seen = self.known[at] == uniq if len(self.known) else np.zeros(len(uniq), bool)
        value = np.empty(len(uniq))
        value[seen] = self.value[at[seen]] if len(self.known) else 0
        fresh = np.flatnonzero(~seen)
        for a in range(0, len(fresh), 20_000):
            some = fresh[a:a + 20_000]
            made = self.kernel.values(*_pick(codes, first, one[some]))
            value[some] = made @ self.model["fold"] + self.model["bias"]
        if len(self.known) + len(fresh) > KNOWN_WORDS:
            self.known, self.value = uniq, value
        elif len(fresh):
            known = np.concatenate([self.known, uniq[fresh]])
            order = np.argsort(known)
            self.known, self.value = known[order], np.concatenate([self.value, value[fresh]])[order]
        return value[back]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        codes, first, row, sentence = units(data, offsets)
        value = self.words(codes, first) if len(row) else np.zeros(0)
        x = _summary(value, row, sentence, len(offsets) - 1)
        w = self.model["logistic"]
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", at: float = 0.7,
) -> DataFrame:
    """Per row: id, held_out, score from 0 to 1, predicted.

    Learns from at most ``TOXIC_TEXTS`` and ``CLEAN_TEXTS`` labelled texts of at most
    ``TEXT_CHARS`` characters, those whose ids have the smallest hashes; scores every whole text,
    empty and null ones as texts without words. Null labels and ids teach nothing; of several labels
    of an id the greatest counts, of several texts the smallest; without usable labels of both
    classes every score is their smoothed share of toxic ones. Repeated rows give repeated rows.
    Other columns are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    known = known_labels(labels, held_out, doc_id, label)
    texts: list[str] = []
    marks: list[int] = []
    for mark, most in ((1, TOXIC_TEXTS), (0, CLEAN_TEXTS)):
        picked = smallest_hashes(known.filter(F.col("label") == mark), most, 5).select("id")
        source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.length(text) <= TEXT_CHARS)
        found = lookup_join(source.filter("id IS NOT NULL"), picked, ["id"]).groupBy("id").agg(F.min("text").alias("text"))
        got = [r["text"] for r in found.orderBy("id").collect()]
        texts += got
        marks += [mark] * len(got)
    model = learn(texts, np.array(marks, np.int64))
    share = (sum(marks) + 0.5) / (len(marks) + 1)
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value else None
        for batch, data, offsets in text_slabs(batches, "text", 1 << 20):
            score = scorer.texts(data, offsets) if scorer else np.full(len(offsets) - 1, share)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(score), pa.array((score >= at).astype(np.int32))],
                ["id", "score", "predicted"])

    scored = source.mapInArrow(rows, f"id {kind}, score double, predicted int").withColumnRenamed("id", doc_id)
    return scored.select(doc_id, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op6_string_kernel")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, taught by the labels of two thirds of the ids."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), third_of_ids())
