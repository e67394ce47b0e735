"""BPE encoding by content-defined chunk reuse.

A text is cut by the gear hash into chunks; passages that documents share give the same chunks,
and a task encodes each distinct chunk once while it is among the ``CACHE_BYTES`` it remembers.
Cuts fall anywhere, so the ids around a join of two chunks are wrong at first. A join is repaired
by encoding the text around it again: from the last point of the left chunk to the first point of
the right chunk where the scan of words must break whatever stands around it (a printable ASCII
character, then a blank or line end). There the ids of the repaired piece must meet token ends of
both chunks; if a chunk has no such point, or the ends don't meet, the window grows over the next
chunk, until they agree. Beyond those points nothing the other chunk holds can change an id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.gear import boundaries
from quayside.llm.registry import query, table
from quayside.llm.text import text_slabs
from quayside.llm.tokens import Encoder, vocabulary_path

LEAST, USUAL, MOST = 128, 512, 4096
CACHE_BYTES = 24 << 20
_BREAK = re.compile(rb"[!-~](?=[ \n])")


class ChunkEncoder:
    """Ids of texts from remembered chunks; ``reused`` counts chunks that were not encoded again."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self._length = np.array([len(b) for b in self.encoder.bytes], np.int64)
        self._chunks: dict[bytes, tuple] = {}
        self._joins: dict[bytes, np.ndarray] = {}
        self._size = 0
        self.reused = 0
        self.encoded = 0

    def _chunk(self, data: bytes) -> tuple:
        """(ids, first break, last break, ids before the first, ids before the last); -1: none."""
        known = self._chunks.get(data)
        if known is not None:
            self.reused += 1
            return known
        self.encoded += 1
        ids = self.encoder.encode(data.decode())
        first = _BREAK.search(data)
        made = (ids, -1, -1, 0, 0)
        if first:
            a = first.end()
            b = max(data.rfind(b" "), data.rfind(b"\n"))
            while not _BREAK.match(data, b - 1):  # ends at ``a`` at the latest
                b = max(data.rfind(b" ", 0, b), data.rfind(b"\n", 0, b))
            ends = np.cumsum(self._length[ids])
            x, y = np.searchsorted(ends, [a, b])
            if ends[x] == a and ends[y] == b:
                made = (ids, a, b, int(x) + 1, int(y) + 1)
        if self._size + len(data) > CACHE_BYTES:
            self._chunks.clear()
            self._size = 0
        self._chunks[data] = made
        self._size += len(data)
        return made

    def _join(self, data: bytes) -> np.ndarray:
        known = self._joins.get(data)
        if known is None:
            if len(self._joins) >= 50_000:
                self._joins.clear()
            known = self.encoder.encode(data.decode())
            if len(data) <= 64:
                self._joins[data] = known
        return known

    def encode(self, chunks: list[bytes]) -> np.ndarray:
        """The ids of the joined chunks, equal to those of the whole text."""
        if len(chunks) == 1:
            return self._chunk(chunks[0])[0]
        out: list[np.ndarray] = []
        window: list[bytes] = []  # text behind the last agreed break
        for data in chunks:
            ids, a, b, before_a, before_b = self._chunk(data)
            if a < 0:
                window.append(data)
                continue
            if out or window:
                out.append(self._join(b"".join([*window, data[:a]])))
            else:
                out.append(ids[:before_a])
            out.append(ids[before_a:before_b])
            window = [data[b:]]
        if window:
            out.append(self._join(b"".join(window)))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


def cut_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk bounds of all rows, moved to the next start of a character, and first chunk numbers."""
    starts, firsts = boundaries(data, offsets, LEAST, USUAL, MOST)
    for _ in range(3):
        inside = np.flatnonzero(data[starts] & 0xC0 == 0x80) if len(starts) else []
        starts[inside] += 1
    return starts, firsts


def encode_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, ids: bool = True
) -> DataFrame:
    """Per row: id, n_tokens, token ids (if asked for), SHA-256 of the ids and of the decoded text.

    Null counts as an empty text, which has no tokens. Repeated rows give repeated rows; a null id
    is carried along. Other columns are left out. An empty table gives no rows.
    """
    path = vocabulary or vocabulary_path()
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkEncoder(path)
        decimal = [str(k) for k in range(len(coder.encoder.bytes))]
        for batch, data, offsets in text_slabs(batches, "text"):
            starts, firsts = cut_chunks(data, offsets)
            data = data.tobytes()
            counts, id_hash, text_hash, lists = [], [], [], []
            for row in range(len(offsets) - 1):
                edges = [*starts[firsts[row]:firsts[row + 1]].tolist(), int(offsets[row + 1])]
                got = coder.encode([data[a:b] for a, b in zip(edges, edges[1:])])
                counts.append(len(got))
                id_hash.append(hashlib.sha256(",".join([decimal[k] for k in got.tolist()]).encode()).hexdigest())
                text_hash.append(hashlib.sha256(coder.encoder.decode(got)).hexdigest())
                if ids:
                    lists.append(got.astype(np.int32))
            columns = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()),
                       pa.array(text_hash, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = source.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return source.mapInArrow(rows, shape).withColumnRenamed("id", doc_id)


@query("op4_bpe_chunks")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return encode_texts(table(spark, sf_dir, "documents"), ids=False)
