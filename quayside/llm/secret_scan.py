"""Secrets by fixed patterns, and by two character Markov models compared by their log-likelihood.

Base rules mark assignments, access keys and long hexadecimal runs. The method adds runs of token
characters that look random: a model of random strings and a model of ordinary identifiers give
every character's probability after the one before it, and the stretch of a run with the highest
sum of log ratios (base 2) is a secret where it is long enough and reaches ``LEAST_BITS``.

Both models are taught by labelled samples, counted over all texts. What the base rules mark
teaches the random one, half and half with strings drawn evenly from the usual alphabets, whose
transitions are known without drawing. All other runs that are too short to be judged teach the
ordinary one, so that no candidate teaches the model that judges it; these words also count in
capitals and joined by signs or by a capital, since identifiers are words written so.
A transition's ratio stays within ``MOST_BITS`` either way: no single rare pair decides, and the
ratios hardly depend on how much text there is. The tables have a fixed number of entries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.registry import query, table
from quayside.llm.text import LOWER, text_slabs

# Fixed values of the base rules.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
VALUE_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32

LEAST_BITS, LEAST_CHARS, MOST_BITS = 40.0, 16, 8.0
SMOOTHING = 20.0

LOWERS, UPPERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SIGNS = "_-+/="
SYMBOLS = LOWERS + UPPERS + DIGITS + SIGNS  # and one more for anything else
OTHER = len(SYMBOLS)
SIZE = OTHER + 1
_SYMBOL = np.full(256, OTHER, np.uint8)
_SYMBOL[[ord(c) for c in SYMBOLS]] = np.arange(OTHER)
ALPHABETS = (
    DIGITS + LOWERS[:6], DIGITS + UPPERS[:6], DIGITS + UPPERS, DIGITS + LOWERS, DIGITS + LOWERS + UPPERS,
    DIGITS + LOWERS + UPPERS + "+/", DIGITS + LOWERS + UPPERS + "-_",
)
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True


def runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` true bytes; no run crosses a row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    first = inside & np.concatenate([[True], ~inside[:-1] | edge[1:-1]])
    last = inside & np.concatenate([~inside[1:] | edge[1:-1], [True]])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, start and end (bytes in the slab) of all base spans, and the start of the value in it."""
    found: list[tuple[int, int, int, int]] = []
    whole = data.tobytes()
    low = LOWER[data].tobytes()
    rows: dict[int, None] = {}
    for name in NAMES:
        at = low.find(name)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            rows[row] = None
            at = low.find(name, int(offsets[row + 1]))
    for row in rows:
        a, b = int(offsets[row]), int(offsets[row + 1])
        for m in ASSIGN.finditer(whole[a:b]):
            if m.end(2) - m.start(2) >= VALUE_LEAST:
                found.append((0, a + m.start(), a + m.end(), a + m.start(2)))
    at = whole.find(b"AKIA")
    while at >= 0:
        row = int(np.searchsorted(offsets, at, "right")) - 1
        end = int(offsets[row + 1])
        m = ACCESS.match(whole, at, end)
        if m:
            if m.end() - at >= ACCESS_LEAST:
                found.append((1, at, m.end(), at))
            at = whole.find(b"AKIA", m.end())
        else:
            at = whole.find(b"AKIA", at + 1)
    starts, ends = runs(_HEX[data], offsets, HEX_LEAST)
    found += [(2, int(s), int(e), int(s)) for s, e in zip(starts, ends)]
    spans = np.array(sorted(found, key=lambda f: (f[1], f[0])), np.int64).reshape(-1, 4)
    return spans[:, 0], spans[:, 1], spans[:, 2], spans[:, 3]


def transitions(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each symbol follows each: in short runs outside the base spans, and inside the
    values of these."""
    kinds, starts, ends, values = base_spans(data, offsets)
    symbols = _SYMBOL[data]
    taught = np.zeros(SIZE * SIZE, np.int64)
    covered = np.zeros(len(data) + 1, np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, ends, -1)
    # A value that lies in another span teaches once: hexadecimal runs inside assignments don't.
    reach = 0
    for s, e, v in zip(starts, ends, values):
        v = max(int(v), reach)
        if e - v > 1:
            part = symbols[v:e].astype(np.int64)
            taught += np.bincount(part[:-1] * SIZE + part[1:], minlength=SIZE * SIZE)
        reach = max(reach, int(e))
    plain = symbols.copy()
    plain[np.cumsum(covered[:-1]) > 0] = OTHER
    for s, e in zip(*runs(plain != OTHER, offsets, LEAST_CHARS)):
        plain[s:e] = OTHER
    # One foreign symbol before each row, so that rows never follow one another.
    plain = np.insert(plain, offsets, OTHER).astype(np.uint16)
    return np.bincount(plain[:-1] * np.uint16(SIZE) + plain[1:], minlength=SIZE * SIZE), taught


def count_transitions(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Transition counts over all texts (column ``text``): ordinary and random; a row per pair of
    symbols and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for _, data, offsets in text_slabs(batches, "text"):
            total += np.stack(transitions(data, offsets))
        kind, pair = np.nonzero(total)
        if len(kind):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(pair), pa.array(total[kind, pair])], ["kind", "pair", "n"])

    rows = docs.mapInArrow(count, "kind long, pair long, n long").groupBy("kind", "pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, SIZE * SIZE))
    got = rows.toArrow()  # at most two rows per pair of symbols
    counts[got.column("kind").to_numpy(), got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return counts[0].reshape(SIZE, SIZE), counts[1].reshape(SIZE, SIZE)


def _of(text: str) -> np.ndarray:
    return np.array([SYMBOLS.index(c) for c in text])


def ordinary_model(counts: np.ndarray) -> np.ndarray:
    """Probabilities of the next symbol in identifiers made of the counted words."""
    low, up, signs = _of(LOWERS), _of(UPPERS), _of("_-/")
    folded = counts.copy()
    folded[OTHER, OTHER] = 0
    made = folded.copy()
    words = folded[np.ix_(low, low)] + folded[np.ix_(up, low)] + folded[np.ix_(up, up)]
    first = folded[OTHER, low] + folded[OTHER, up]  # letters that begin words
    last = folded[low, OTHER]                       # letters that end them
    made[np.ix_(up, up)] += words / 4
    made[np.ix_(low, low)] += words / 4
    made[np.ix_(up, low)] += words / 16
    share = first / max(first.sum(), 1)
    made[np.ix_(low, up)] += np.outer(last, share) / 4
    for sign in signs:
        made[low, sign] += last / 8
        made[up, sign] += last / 16
        made[sign, low] += first / 8
        made[sign, up] += first / 16
    digits = _of(DIGITS)
    for letters in (low, up):
        made[np.ix_(letters, digits)] += np.outer(last, np.ones(10)) / 160
    for sign in signs:
        made[sign, digits] += first.sum() / 160
        made[digits, sign] += first.sum() / 160
    made[np.ix_(digits, digits)] += first.sum() / 200
    made = made[:OTHER, :OTHER]
    often = made.sum(0) + 1
    return (made + SMOOTHING * often / often.sum()) / (made.sum(1, keepdims=True) + SMOOTHING)


def random_model(counts: np.ndarray) -> np.ndarray:
    """Probabilities of the next symbol in random strings: even alphabets, and the counted values."""
    even = np.full((OTHER, OTHER), 1e-3 / OTHER)
    for alphabet in ALPHABETS:
        at = _of(alphabet)
        even[np.ix_(at, at)] += 1 / len(at) ** 2
    even /= even.sum(1, keepdims=True)
    seen = counts[:OTHER, :OTHER]
    total = seen.sum(1, keepdims=True)
    return np.where(total > 0, (even + (seen + even) / (total + 1)) / 2, even)


def log_ratios(ordinary: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Bits that each transition adds for random against ordinary, from counts. A symbol after
    itself adds none: a repeated character is filler."""
    ratio = np.clip(np.log2(random_model(random) / ordinary_model(ordinary)), -MOST_BITS, MOST_BITS)
    np.fill_diagonal(ratio, np.minimum(ratio.diagonal(), 0))
    return ratio


def random_spans(
    data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray, covered: np.ndarray, least: float = LEAST_BITS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and bits of the random stretches outside ``covered``.

    A run of token characters gives one stretch, the one with the highest sum, widened to whole
    letters and digits at both ends; what is left of the run on both sides is searched again.
    """
    symbols = _SYMBOL[data]
    starts, ends = runs((symbols != OTHER) & ~covered, offsets, LEAST_CHARS)
    out = []
    todo = list(zip(starts.tolist(), ends.tolist()))
    while todo:
        a, b = todo.pop()
        part = symbols[a:b].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(ratios[part[:-1], part[1:]])])
        lowest = np.minimum.accumulate(sums)
        end = int((sums - lowest).argmax())
        bits = float(sums[end] - lowest[end])
        if bits < least:
            continue
        start = int(sums[:end + 1].argmin())
        alnum = part < len(LOWERS + UPPERS + DIGITS)
        while start > 0 and alnum[start] and alnum[start - 1]:
            start -= 1
        while end + 1 < len(part) and alnum[end] and alnum[end + 1]:
            end += 1
        while start < end and not alnum[start]:
            start += 1
        while end > start and not alnum[end] and part[end] != OTHER - 1:  # padding '=' stays
            end -= 1
        end += 1
        if end - start >= LEAST_CHARS:
            out.append((a + start, a + end, bits))
        for x, y in ((a, a + start), (a + end, b)):
            if y - x >= LEAST_CHARS and y - x < b - a:
                todo.append((x, y))
    out.sort()
    table_ = np.array(out, float).reshape(-1, 3)
    return table_[:, 0].astype(np.int64), table_[:, 1].astype(np.int64), table_[:, 2]


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST_BITS
) -> DataFrame:
    """Per row: id, spans (array of kind, start, end, bits), by start and then by kind in the order
    of ``KINDS``; positions are code points, ends are exclusive, bits are null for base spans.

    Base spans of different kinds may overlap; random ones overlap none. Matches that are too
    short are dropped but used up, as a search does. A null text is empty and has no spans.
    Repeated rows are searched each; other columns are left out. An empty table gives no rows.
    """
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    ratios = log_ratios(*count_transitions(source.select("text")))
    kind = source.schema["id"].dataType.simpleString()
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slabs(batches, "text"):
            kinds, starts, ends, _ = base_spans(data, offsets)
            covered = np.zeros(len(data) + 1, np.int32)
            np.add.at(covered, starts, 1)
            np.add.at(covered, ends, -1)
            more = random_spans(data, offsets, ratios, np.cumsum(covered[:-1]) > 0, least)
            bits = np.concatenate([np.full(len(kinds), np.nan), more[2]])
            kinds = np.concatenate([kinds, np.full(len(more[0]), 3, np.int64)])
            starts, ends = np.concatenate([starts, more[0]]), np.concatenate([ends, more[1]])
            order = np.lexsort((kinds, starts))
            kinds, starts, ends, bits = kinds[order], starts[order], ends[order], bits[order]
            firsts = np.searchsorted(starts, offsets)
            # Code points before each byte, counted only inside rows that have spans.
            for row in np.flatnonzero(np.diff(firsts)):
                a, b = firsts[row], firsts[row + 1]
                begins = np.concatenate([[0], np.cumsum(data[offsets[row]:offsets[row + 1]] & 0xC0 != 0x80)])
                starts[a:b], ends[a:b] = begins[starts[a:b] - offsets[row]], begins[ends[a:b] - offsets[row]]
            spans = pa.StructArray.from_arrays(
                [pa.array(np.array(KINDS, object)[kinds], pa.string()), pa.array(starts), pa.array(ends),
                 pa.array(bits, pa.float64(), mask=np.isnan(bits))], fields=list(entry))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), spans)], ["id", "spans"])

    schema = f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,bits:double>>"
    return source.mapInArrow(rows, schema).withColumnRenamed("id", doc_id)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op11_secret_scan")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets in every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
