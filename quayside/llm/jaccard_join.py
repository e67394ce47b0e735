"""N-gram Jaccard join: texts whose sets of word shingles are nearly equal, and their groups.

A text's set holds its distinct shingles of ``width`` words (A-Z lower-cased); a shorter text is
one shingle, a text without words has no set and no partner. Texts with equal sets become one node
(64-bit hashes of shingles and sets stand for them throughout). Two nodes are linked when
100 * intersection >= percent * union.

Candidates come from adaptive multi-match prefixes. All shingles follow one order, rare ones first;
rarity is estimated by a sketch, sized by the words of the corpus up to 2**SKETCH_MOST counters a
row, which every task counts over all texts. Of a set of n, at least t = ceil(percent * n / 100)
shingles must be shared with any partner. So two partners share at least l shingles within the first
n - t + l of each. Every node picks its own l, up to all its set allows: with a longer prefix a pair
needs more matches before it is verified, so few pairs remain where the shingles of a prefix are
frequent. A pair uses the smaller l. Whatever l, partners share one of the first n - t + 1, so only
these are index entries; the longer prefix stays with its node. Partners meet first at their rarest
common shingle: at places p and q of an n and an m they share at most min(n - p, m - q), and an
entry where that is too little writes nothing. Nor does one where the two share a shingle before it
among the first few that every entry carries: they have met there. Of the pairs written, those with
fewer than l shared shingles in their prefixes go before any set is fetched.

Groups of many near copies would make quadratically many pairs. Two steps keep them from being
written: first each node is verified against the most typical node of each of its index entries
(as many pairs as entries), and the components of those links are found; then only pairs
of different components are taken further, and only if their parity signatures allow the needed
overlap (two sets that differ in d shingles differ in at most d bits, so no link is lost; larger
sets have longer signatures, which fold to the shorter ones').
An index entry beyond ``TILE`` nodes is split into tiles which meet pairwise, so no task holds more
than two of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.registry import query, table
from quayside.llm.text import (
    LOWER, binary_column, mix, per_row_sum, rows_of, spans_hash, text_slabs, words,
)
from quayside.operators.skew import lookup_join
from quayside.session import discard, durable

SKETCH_LEAST, SKETCH_MOST = 14, 21  # bits of a counter's number
WORD_BYTES, COUNTER_WORDS = 6, 8  # the sketch has a counter for so many words of so many bytes
EARLY = 4  # first shingles that an entry carries
TILE = 4096
BUCKETS = 1 << 22  # of ids, to leave out most texts that are not asked for
SIGNATURE_BITS, SIGNATURE_LEVELS = 256, 3  # 256 bits up to 1024 shingles, then four times as many
_PLACES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                       0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and each row's first item number."""
    data = LOWER[data]
    starts, ends, firsts = words(data, offsets)
    word = spans_hash(data, starts, ends)
    n = np.diff(firsts)
    first = np.concatenate([[0], np.cumsum(np.where(n > 0, np.maximum(n - width + 1, 1), 0))])
    row = rows_of(first)
    at = np.arange(first[-1]) - first[row] + firsts[row]
    last = firsts[row + 1] - 1
    value = np.zeros(len(at), np.uint64)
    for k in range(width):
        there = at + k <= last
        key = word[np.minimum(at + k, len(word) - 1)] if len(word) else value
        value += np.where(there, key * _PLACES[k % 5] + np.uint64(k // 5 + 1), np.uint64(0))
    value = mix(value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])


def set_ids(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; equal sets have equal ids."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(1)), dtype=np.uint64)])
    ids = total[firsts[1:]] - total[firsts[:-1]]
    return mix(ids + np.diff(firsts).astype(np.uint64)).view(np.int64)


def _cells(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return (values >> np.uint64(64 - bits)).astype(np.int64), (values & low).astype(np.int64)


def sketch_bits(size: int) -> int:
    """Bits for a corpus of so many bytes of text."""
    counters = size // (WORD_BYTES * COUNTER_WORDS)
    return min(max(int(counters).bit_length(), SKETCH_LEAST), SKETCH_MOST)


def shingle_sketch(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """How many sets hold a shingle, at least: two rows of counters over all texts.

    Each task sends its counters once, compressed and in pieces that are added up in two levels;
    what reaches the driver is one sketch. The counts only order shingles and weigh costs.
    """
    pieces = 32
    bits = sketch_bits(docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"])
    length = (2 << bits) // pieces

    def packed(counts: np.ndarray) -> bytes:
        return pa.compress(np.minimum(counts, 2**31 - 1).astype(np.int32).tobytes(), codec="zstd", asbytes=True)

    def unpacked(value: pa.Scalar) -> np.ndarray:
        return np.frombuffer(pa.decompress(value.as_buffer(), 4 * length, codec="zstd"), np.int32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int64)
        for _, data, offsets in text_slabs(batches, text):
            values, _ = shingle_sets(data, offsets, width)
            for row, cell in zip(counts, _cells(values, bits)):
                np.add.at(row, cell, 1) if len(cell) < len(row) // 8 else np.add(row, np.bincount(cell, minlength=len(row)), out=row)
        import random
        lane = random.randrange(1 << 16)
        parts = counts.reshape(pieces, -1)
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(range(pieces), pa.int32()), "lane": pa.array([lane] * pieces, pa.int32()),
            "counts": pa.array([packed(p) for p in parts], pa.binary()),
        })

    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        total = np.zeros(length, np.int64)
        for value in group.column("counts"):
            total += unpacked(value)
        return pa.table({
            "piece": pa.array([key[0].as_py()], pa.int32()), "lane": pa.array([0], pa.int32()),
            "counts": pa.array([packed(total)], pa.binary()),
        })

    shape = "piece int, lane int, counts binary"
    counted = docs.select(text).mapInArrow(count, shape).withColumn("lane", F.col("lane") % 64)
    levels = counted.groupBy("piece", "lane").applyInArrow(add, shape)
    whole = np.zeros((pieces, length), np.int32)
    rows = levels.groupBy("piece").applyInArrow(add, shape).toArrow()
    for piece, value in zip(rows.column("piece").to_pylist(), rows.column("counts")):
        whole[piece] = unpacked(value)
    return whole.reshape(2, -1)


def _levels(n: np.ndarray) -> np.ndarray:
    """Signature level of sets of these sizes; level k has SIGNATURE_BITS * 4**k bits."""
    bounds = 4 * SIGNATURE_BITS * 4 ** np.arange(SIGNATURE_LEVELS - 1)
    return np.searchsorted(bounds, n, "left")


def signatures(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows' signatures and their offsets: bit b is the parity of the number of
    shingles that fall on b."""
    n = np.diff(firsts)
    width = SIGNATURE_BITS * 4 ** _levels(n)
    start = np.concatenate([[0], np.cumsum(width)])
    cell = (values >> np.uint64(40)).astype(np.int64) % np.repeat(width, n) + np.repeat(start[:-1], n)
    return np.packbits((np.bincount(cell, minlength=start[-1]) & 1).astype(np.uint8)), start // 8


def apart(column: pa.Array, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits of the signatures of rows i and j, the longer folded to the shorter."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(n) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    level = _levels(n)
    low = np.minimum(level[i], level[j])
    out = np.zeros(len(i), np.int64)
    for k in np.unique(low):
        size = SIGNATURE_BITS // 8 * 4**k
        rows = np.flatnonzero((level == k) | (level == k + 1))
        rows = rows[np.isin(rows, np.concatenate([i[low == k], j[low == k]]))]
        bits = np.zeros((len(rows), size // 8), np.uint64)
        for up in (0, 1):
            own = np.flatnonzero(level[rows] == k + up)
            if len(own):
                spans = offsets[rows[own]][:, None] + np.arange(size * 4**up)
                bits[own] = np.bitwise_xor.reduce(data[spans].reshape(len(own), 4**up, size), axis=1).view(np.uint64)
        place = np.zeros(len(n), np.int64)
        place[rows] = np.arange(len(rows))
        pairs = np.flatnonzero(low == k)
        step = max(1, (8 << 20) // size)
        for a in range(0, len(pairs), step):
            some = pairs[a:a + step]
            out[some] = np.bitwise_count(bits[place[i[some]]] ^ bits[place[j[some]]]).sum(axis=1, dtype=np.int64)
    return out


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def describe(docs: DataFrame, sketch, text: str, keep: list[str], width: int, percent: int) -> DataFrame:
    """One row per text: set id, size, prefix, number of matches asked for, signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        noise, bits = counts.mean(axis=1), counts.shape[1].bit_length() - 1
        for batch, data, offsets in text_slabs(batches, text):
            values, firsts = shingle_sets(data, offsets, width)
            n, row = np.diff(firsts), rows_of(firsts)
            df = np.minimum(*[c[cell] - m for c, cell, m in zip(counts, _cells(values, bits), noise)])
            df = np.maximum(df, 1.0)
            order = np.lexsort((values, df, row))
            df, ordered = df[order], values[order]
            sums = np.concatenate([[0.0], np.cumsum(df)])
            base = n - _needed(n, percent)
            # Cost of l: a longer prefix, and of the others met there at most 1/l as many pairs to verify.
            best, cost, l = np.minimum(1, n), np.full(len(n), np.inf), 1
            while (l <= n - base).any():
                length = np.minimum(base + l, n)
                others = sums[firsts[:-1] + length] - sums[firsts[:-1]] - length
                this = np.where(l <= n - base, length + others * (1 + n / 16 / l), np.inf)
                best, cost = np.where(this < cost, l, best), np.minimum(this, cost)
                l += max(1, l // 3)
            length = np.minimum(base + best, n)
            starts = np.concatenate([[0], np.cumsum(length)])
            which = rows_of(starts)
            prefix = ordered[np.arange(starts[-1]) - starts[which] + firsts[which]]
            at = starts[:-1][:, None] + np.arange(EARLY)
            early = np.where(at < starts[1:][:, None], np.append(prefix, np.uint64(0))[np.minimum(at, len(prefix))], np.uint64(0))
            typical = per_row_sum(np.log(df), firsts) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(batch.schema.get_field_index(c)) for c in keep],
                pa.array(set_ids(values, firsts)), pa.array(n.astype(np.int64)),
                pa.array(base.astype(np.int32)), pa.array(best.astype(np.int32)),
                pa.array(typical), binary_column(*signatures(values, firsts)),
                binary_column(early.view(np.uint8).ravel(), np.arange(len(n) + 1) * 8 * EARLY),
                binary_column(prefix.view(np.uint8), starts * 8),
            ], [*keep, *NODE, "prefix"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInArrow(
        rows, f"{kept}, sid long, n long, base int, matches int, typical double, signature binary, early binary, "
              "prefix binary"
    )


NODE = ("sid", "n", "base", "matches", "typical", "signature", "early")


def _entries(nodes: DataFrame) -> DataFrame:
    """Index entries (shingle, node, place in the prefix) whose shingle two nodes share: of each node
    the first ``base + 1`` shingles, of which partners share one whatever their l."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("prefix")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
            prefix = np.frombuffer(column.buffers()[2] or b"", np.int64)
            firsts = np.concatenate([[0], np.cumsum(batch.column("base").to_numpy() + 1)])
            row = rows_of(firsts)
            place = np.arange(firsts[-1]) - firsts[row]
            values = prefix[offsets[row] // 8 + place]
            sid = batch.column("sid").to_numpy()
            for a in range(0, len(values), 1 << 18):
                b = slice(a, a + (1 << 18))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[b]), pa.array(sid[row[b]]), pa.array(place[b].astype(np.int32))],
                    ["shingle", "sid", "place"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by shingle: drop those of one row. One row is held back between batches."""
        held, held_shared = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            value = batch.column("shingle").to_numpy()
            after = np.append(value[1:] == value[:-1], False)
            before = np.insert(value[1:] == value[:-1], 0, held is not None and held.column(0)[0].as_py() == value[0])
            if held is not None and (held_shared or before[0]):
                yield held
            keep = after | before
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep[:-1]))
            held, held_shared = batch.slice(batch.num_rows - 1), bool(before[-1])
        if held is not None and held_shared:
            yield held

    shape = "shingle long, sid long, place int"
    spread = nodes.select("sid", "base", "prefix").mapInArrow(explode, shape)
    return spread.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(shared, shape)


def _pairs(members: DataFrame, percent: int, typical_only: bool) -> DataFrame:
    """Candidate pairs inside index entries, each written where the two first meet.

    ``typical_only``: each node with the most typical one of its entry. Otherwise all pairs of
    different components. Both only as sizes, places and signatures allow. A pair whose first
    common shingle is not among the early ones of both may be written more than once, but only at
    shingles rare enough to be the first that partners share.
    """
    shape = "a long, b long, matches int"

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            whole = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([whole.column(c).to_numpy() for c in ("shingle", "tile", "other")])
            new = np.ones(whole.num_rows, bool)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            cut = int(np.flatnonzero(new)[-1]) if whole.num_rows else 0
            yield from compare(whole.slice(0, cut), new[:cut])
            rest = whole.slice(cut)
        if rest is not None and rest.num_rows:
            yield from compare(rest, np.arange(rest.num_rows) == 0)

    def compare(part: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        if part.num_rows < 2:
            return
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(new))
        stop = np.repeat(stops, stops - starts)
        sid, n = part.column("sid").to_numpy(), part.column("n").to_numpy()
        place, block, tile, other = (part.column(c).to_numpy() for c in ("place", "block", "tile", "other"))
        column = part.column("signature")
        if not typical_only:
            matches, component = part.column("matches").to_numpy(), part.column("component").to_numpy()
            early = part.column("early")
            first = np.frombuffer(early.buffers()[1], np.int32)[early.offset]
            early = np.frombuffer(early.buffers()[2], np.uint64, count=part.num_rows * EARLY, offset=int(first)).reshape(-1, EARLY)

        def allowed(i, j):
            small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            ok = (100 * small >= percent * large) & (sid[i] != sid[j])
            ok &= (block[i] != block[j]) | (tile[i] == other[i])  # pairs of one block: in its own tile
            i, j = i[ok], j[ok]
            need = -(-percent * (n[i] + n[j]) // (100 + percent))
            if not typical_only:
                ok = component[i] != component[j]
                i, j, need = i[ok], j[ok], need[ok]
            met = np.zeros(len(i), bool)
            if not typical_only:
                # Where the two share an early shingle before this one, they have met there.
                for x in range(EARLY):
                    for y in range(EARLY):
                        met |= (early[i, x] == early[j, y]) & (x < place[i]) & (y < place[j])
            # Where two first meet they share this one and at most all that follow.
            ok = ~met & (np.minimum(n[i] - place[i], n[j] - place[j]) >= need)
            i, j, need = i[ok], j[ok], need[ok]
            ok = apart(column, n, i, j) <= n[i] + n[j] - 2 * need
            return i[ok], j[ok]

        def batch_of(i, j):
            a, b = np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j])
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(np.minimum(matches[i], matches[j]))], ["a", "b", "matches"])

        if typical_only:
            order = np.lexsort((sid, part.column("typical").to_numpy(), np.repeat(np.arange(len(starts)), stops - starts)))
            pivot = np.repeat(order[stops - 1], stops - starts)
            i, j = allowed(pivot, np.arange(len(n)))
            pair = np.unique(np.stack([np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j])]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[0]), pa.array(pair[1]), pa.array(np.ones(pair.shape[1], np.int32))], ["a", "b", "matches"])
            return
        # The entry is sorted by size: compare with the next, the second next ... while both fit.
        i, step = np.arange(len(n)), 1
        while len(i):
            i = i[i + step < stop[i]]
            i = i[percent * n[i + step] <= 100 * n[i]]
            x, y = allowed(i, i + step)
            if len(x):
                yield batch_of(x, y)
            step += 1

    asked = ("sid", "shingle", "place", "block", "tile", "other", "n", "signature",
             *(["typical"] if typical_only else ["matches", "early", "component"]))
    dealt = members.select(*asked).repartition("shingle", "tile", "other").sortWithinPartitions("shingle", "tile", "other", "n", "sid")
    return dealt.mapInArrow(pairs, shape)


def _tiled(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """Entries with what their nodes need for comparing, large ones dealt to pairs of tiles."""
    large = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > TILE)
    sized = lookup_join(entries, large, ["shingle"], "left")
    tiles = F.ceil(F.coalesce("_rows", F.lit(1)) / TILE).cast("int")
    block = F.pmod(F.xxhash64("sid"), tiles).cast("int")
    spread = sized.select(
        "shingle", "sid", "place", block.alias("block"),
        F.explode(F.sequence(F.lit(0), tiles - 1)).alias("_with"),
    ).select(
        "shingle", "sid", "place", "block", F.least("block", "_with").alias("tile"),
        F.greatest("block", "_with").alias("other"),
    )
    return spread.join(nodes.select(*[c for c in NODE if c != "base"]), "sid")


def _matching(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that share as many shingles in their prefixes as the smaller l asks for."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, x_base, y_base, l in zip(*(batch.column(c) for c in ("prefix_a", "prefix_b", "base_a", "base_b", "matches"))):
                l = l.as_py()
                x, y = (np.frombuffer(v.as_buffer(), np.uint64)[:k.as_py() + l] for v, k in ((x, x_base), (y, y_base)))
                keep.append(len(np.intersect1d(x, y, assume_unique=True)) >= l)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    several = pairs.filter("matches > 1")
    wanted = several.select(F.col("a").alias("sid")).union(several.select("b")).distinct()
    asked = durable(lookup_join(nodes.select("sid", "base", "prefix"), wanted, ["sid"], "left_semi"), "prefixes")
    sides = [asked.select(*[F.col(c).alias(x if c == "sid" else f"{c}_{x}") for c in asked.columns]) for x in ("a", "b")]
    counted = several.join(sides[0], "a").join(sides[1], "b").select(
        "a", "b", "matches", "base_a", "base_b", "prefix_a", "prefix_b").mapInArrow(count, "a long, b long")
    return pairs.filter("matches <= 1").select("a", "b").union(counted)


def _asked(docs: DataFrame, ids: DataFrame, doc_id: str) -> DataFrame:
    """The rows whose id falls into a bucket with one of ``ids``: a superset of those asked for, found
    by a broadcast of at most BUCKETS numbers, so that a join by id does not shuffle all texts."""
    bucket = F.pmod(F.xxhash64(doc_id), F.lit(BUCKETS)).cast("int").alias("_bucket")
    filled = ids.select(bucket).distinct()
    return docs.withColumn("_bucket", bucket).join(F.broadcast(filled), "_bucket", "left_semi").drop("_bucket")


def _linked(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that hold exactly, from the whole sets of their texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slabs(batches, text):
            values, firsts = shingle_sets(data, offsets, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_ids(values, firsts)), binary_column(values.view(np.uint8), firsts * 8)], ["sid", "set"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    texts = durable(
        lookup_join(nodes.select("sid", "doc"), wanted, ["sid"], "left_semi").select(F.col("doc").alias(doc_id), "sid"), "asked")
    found = lookup_join(_asked(docs.select(doc_id, text), texts, doc_id), texts, [doc_id], "inner", stored=True)
    made = found.select(text).mapInArrow(sets, "sid long, set binary")
    unnamed = nodes.filter("doc is null").select("sid")
    if not unnamed.isEmpty():  # no id to fetch their texts by: the sets tell which are asked for
        others = docs.filter(F.col(doc_id).isNull()).select(text).mapInArrow(sets, "sid long, set binary")
        made = made.union(lookup_join(others, unnamed.join(wanted, "sid", "left_semi"), ["sid"], "left_semi"))
    stored = durable(made.dropDuplicates(["sid"]), "sets")
    a = stored.select(F.col("sid").alias("a"), F.col("set").alias("set_a"))
    b = stored.select(F.col("sid").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """Per row: its id, ``n_shingles``, ``component_id`` (smallest id reachable by links).

    Null and blank texts have 0 shingles and are their own component; repeated rows and equal texts
    share a component; a null id never becomes a component's id unless all are null. Other columns
    are left out, so their names can't clash. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(shingle_sketch(docs, text, width))
    described = durable(
        describe(docs.select(F.col(doc_id).alias("doc"), text), sketch, text, ["doc"], width, percent), "sets")
    nodes = durable(
        described.filter("n > 0").groupBy("sid").agg(
            F.min("doc").alias("doc"), *[F.first(c).alias(c) for c in (*NODE[1:], "prefix")]
        ), "nodes")
    places = durable(described.select("doc", "sid", "n"), "places")
    discard(described)  # its prefixes are in the nodes
    entries = durable(_entries(nodes), "entries")
    members = durable(_tiled(entries, nodes), "members")
    discard(entries)

    first = durable(_pairs(members, percent, True).select("a", "b").distinct(), "pairs")
    links = durable(_linked(first, docs, doc_id, text, nodes, width, percent), "links")
    known = components(links)
    met = lookup_join(members, known.withColumnRenamed("node", "sid"), ["sid"], "left").withColumn(
        "component", F.coalesce("component", "sid"))
    written = durable(_pairs(met, percent, False).distinct(), "pairs")
    discard(members)
    second = durable(_matching(written, nodes).join(first, ["a", "b"], "left_anti"), "pairs")
    more = durable(_linked(second, docs, doc_id, text, nodes, width, percent), "links")
    final = components(links.union(more))

    # A component is named by the smallest id of its nodes; a node has the smallest id of its texts.
    linked = durable(final.withColumnRenamed("node", "sid").join(nodes.select("sid", "doc"), "sid"), "linked")
    smallest = linked.groupBy("component").agg(F.min("doc").alias("_smallest"))
    of_node = nodes.select("sid", "doc").join(
        lookup_join(linked, smallest, ["component"]).select("sid", "_smallest"), "sid", "left"
    ).select("sid", F.coalesce("_smallest", "doc").alias("_smallest"))
    placed = lookup_join(places, of_node.filter("_smallest is not null"), ["sid"], "left")
    return placed.select(
        F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_smallest")).otherwise(F.col("doc")).alias("component_id"),
    )


def one_per_group(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """The rows, unchanged, whose id is its group's smallest; of rows with equal ids only one.

    Rows without an id stay: they can't be told apart, so none is dropped for another."""
    groups = durable(near_groups(docs, doc_id, text, width, percent), "groups")
    gone = groups.filter(F.col(doc_id) != F.col("component_id")).select(doc_id).distinct()
    kept = lookup_join(docs, gone, [doc_id], "left_anti").select(*docs.columns)
    repeated = groups.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(
        F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(doc_id)
    if repeated.isEmpty():
        return kept
    return lookup_join(kept, repeated, [doc_id], "left_anti").select(*docs.columns).union(
        lookup_join(kept, repeated, [doc_id], "left_semi").select(*docs.columns).dropDuplicates([doc_id]))


GROUPS_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS s
  FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)"""


@query("op3_jaccard_join", GROUPS_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with near-equal sets of 3-word shingles."""
    return near_groups(table(spark, sf_dir, "documents"))
