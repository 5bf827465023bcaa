"""Substring dedup: Rabin-Karp hashes of every window of words, counted across the corpus.

The texts are read in chunks of neighbouring rows. Each window of a chunk is hashed with two polynomials over word hashes,
96 bits together, at which false equalities are not to be expected among 10**13 windows. Of the windows that
repeat inside the chunk, only those in the smallest document travel on: the others are known to go. So a passage that a
third of all documents share travels once for each chunk, not for each document. The travelling hashes are packed by
hash range into compressed-friendly byte planes (no row for each window), and every range finds the smallest document
of each hash. What is to go is written as window starts to a shelf by places in the files; the second pass over the
texts reads it, merges overlapping windows into maximal intervals and leaves out the words in them.

The texts themselves are never shuffled, and no chunk depends on ids, so rows that share one id are spread like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, order_id, shuffle_partitions, text_of
from .places import Shelf, in_files, place_of, shelve

#: An odd multiplier for the polynomial, and one for the final mix; fixed so that results repeat.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)
#: The same for the second hash.
BASE2 = np.uint64(0xC2B2AE3D27D4EB4F)

#: Characters and rows of a chunk, and characters whose windows make up a range.
CHARS_IN_CHUNK, ROWS_IN_BLOCK = 5 << 20, 4096
CHARS_IN_RANGE = 6 << 20


def window_hashes(words: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """The hash of the window from each place of an array of word hashes, modulo 2**64."""
    n = len(words) - width + 1
    value = np.zeros(max(n, 0), np.uint64)
    for j in range(width if n > 0 else 0):
        value = value * base + words[j : j + n]
    value ^= value >> np.uint64(32)
    value *= MIX
    return value ^ (value >> np.uint64(29))


def planes(values: np.ndarray) -> bytes:
    """The bytes of an array, least significant ones first: bytes that are alike stand together."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplanes(data: memoryview, dtype: str, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data[: n * size], np.uint8).reshape(size, n).T).view(dtype).ravel()


class Chunk:
    """Rows of one block of a file in order of id, as one sequence of words."""

    def __init__(self, ids: list[int], texts: list[str], rows: list[int], width: int) -> None:
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        self.ids, self.rows = np.array([ids[i] for i in order], np.int64), np.array([rows[i] for i in order], np.int64)
        self.words: list[bytes] = []
        sizes = []
        for i in order:
            words = texts[i].encode("utf-8", "replace").split()
            self.words += words
            sizes.append(len(words))
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.width = width

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and both hashes of the windows inside one document."""
        number: dict[bytes, int] = {}
        codes = np.array([number.setdefault(w, len(number)) for w in self.words], np.int64)
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        if len(codes) < self.width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        places = np.flatnonzero(doc[: len(codes) - self.width + 1] == doc[self.width - 1 :])
        first, second = (window_hashes(np.array([xxhash.xxh64_intdigest(w, seed) for w in number], np.uint64)[codes], self.width, base)[places] for seed, base in ((0, BASE), (1, BASE2)))
        return places, first, (second >> np.uint64(32)).astype(np.uint32)

    def doc_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")


def _smallest(hashes: np.ndarray, more: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal windows together, smallest ids first, and the smallest id of each in that order."""
    order = np.lexsort((ids, more, hashes))
    a, b = hashes[order], more[order]
    head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(order) else np.zeros(0, bool)
    return order, ids[order[np.flatnonzero(head)]][np.cumsum(head) - 1] if len(order) else ids


def _pack_starts(docs: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> bytes:
    """Window starts by document, sorted by document and start: rows, runs of each, first starts and lengths."""
    cut = np.flatnonzero((np.diff(docs) != 0) | (np.diff(starts) != 1)) + 1
    first = np.r_[0, cut].astype(np.int64)
    lengths = np.diff(np.r_[first, len(starts)]).astype(np.uint32)
    own, runs = np.unique(docs[first], return_counts=True)
    head = len(own).to_bytes(8, "little") + len(first).to_bytes(8, "little")
    return head + planes(rows[own]) + planes(runs.astype(np.uint32)) + planes(starts[first].astype(np.int64)) + planes(lengths)


def _unpack_starts(data: bytes) -> dict[int, np.ndarray]:
    """The window starts of each row."""
    docs, n, view = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little"), memoryview(data)[16:]
    rows, view = unplanes(view, "<i8", docs), view[8 * docs :]
    runs, view = unplanes(view, "<u4", docs).astype(np.int64), view[4 * docs :]
    first, lengths = unplanes(view, "<i8", n), unplanes(view[8 * n :], "<u4", n).astype(np.int64)
    out, at = {}, 0
    for row, k in zip(rows.tolist(), runs.tolist()):
        f, m = first[at : at + k], lengths[at : at + k]
        out[row] = np.repeat(f - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())
        at += k
    return out


SENT = "range long, file long, row long, kind int, payload binary"


def _told(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], names=[f.split()[0] for f in SENT.split(", ")])


def _send(chunk: Chunk, file: int, block: int, ranges: int) -> Iterator[tuple]:
    """What a chunk sends: hashes of the smallest document's windows by range, and the starts that are known to go."""
    places, hashes, more = chunk.windows()
    if not len(places):
        return
    doc = chunk.doc_at(places)
    starts, ids = places - (chunk.ends - chunk.sizes)[doc], chunk.ids[doc]
    order, least = _smallest(hashes, more, ids)
    gone = np.sort(order[ids[order] > least])
    if len(gone):
        yield (block + file) % ranges, file, block, 1, _pack_starts(doc[gone], starts[gone], chunk.rows)
    first = np.sort(order[ids[order] == least])
    bucket = ((hashes[first] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    turn = np.argsort(bucket, kind="stable")
    first, bucket = first[turn], bucket[turn]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for a, b in zip(edges, [*edges[1:], len(first)]):
        here = first[a:b]
        docs, counts = np.unique(doc[here], return_counts=True)
        head = len(docs).to_bytes(8, "little") + len(here).to_bytes(8, "little")
        body = (chunk.ids[docs], chunk.rows[docs], counts.astype(np.uint32), np.diff(starts[here], prepend=0).astype(np.int32), hashes[here], more[here])
        yield int(bucket[a]), file, block, 0, head + b"".join(map(planes, body))


def _join_range(table: pa.Table) -> pa.Table:
    """The window starts of each block whose hash stands in a smaller document; known starts pass through."""
    sent: list[tuple[int, int, bytes]] = []
    parts: list[tuple] = []
    sources: list[tuple[int, int, np.ndarray]] = []
    for file, block, kind, payload in zip(*(table[c].to_pylist() for c in ("file", "row", "kind", "payload"))):
        if kind == 1:
            sent.append((file, block, payload))
            continue
        docs, n, view = int.from_bytes(payload[:8], "little"), int.from_bytes(payload[8:16], "little"), memoryview(payload)[16:]
        columns = []
        for dtype, size in (("<i8", docs), ("<i8", docs), ("<u4", docs), ("<i4", n), ("<u8", n), ("<u4", n)):
            columns.append(unplanes(view, dtype, size))
            view = view[np.dtype(dtype).itemsize * size :]
        ids, rows, counts, starts, hashes, more = columns
        number = np.repeat(np.arange(docs, dtype=np.int32), counts)
        parts.append((hashes, more, ids[number], np.full(n, len(sources), np.int32), number, np.cumsum(starts, dtype=np.int32)))
        sources.append((file, block, rows))
    if parts:
        hashes, more, ids, source, doc, starts = map(np.concatenate, zip(*parts))
        order, least = _smallest(hashes, more, ids)
        gone = order[ids[order] > least]
        gone = gone[np.lexsort((starts[gone], doc[gone], source[gone]))]
        edges = np.flatnonzero(np.r_[True, np.diff(source[gone]) != 0]) if len(gone) else []
        for a, b in zip(edges, [*edges[1:], len(gone)]):
            file, block, rows = sources[source[gone[a]]]
            sent.append((file, block, _pack_starts(doc[gone[a:b]], starts[gone[a:b]], rows)))
    return pa.table([pa.array([x[i] for x in sent], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["file", "row", "payload"])


def _clean(text: str, starts: list[np.ndarray], width: int) -> tuple[int, int, str, list[dict]]:
    """Numbers of words and of removed ones, the text that is left and the removed intervals."""
    words = text.encode("utf-8", "replace").split()
    if not starts:
        return len(words), 0, b" ".join(words).decode(), []
    edge = np.zeros(len(words) + 1, np.int64)
    for places in starts:
        np.add.at(edge, places, 1)
        np.add.at(edge, places + width, -1)
    gone = np.cumsum(edge[:-1]) > 0
    bounds = np.flatnonzero(np.diff(np.r_[False, gone, False])).reshape(-1, 2)
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words), int(gone.sum()), b" ".join(kept).decode(), [{"start": int(s), "end": int(e)} for s, e in bounds]


class _Gone(Shelf):
    """The starts that are on the shelf for the rows of a block, of which the last is remembered."""

    def __init__(self, path: str, block_rows: int) -> None:
        super().__init__(path)
        self.block_rows, self.block, self.starts = block_rows, None, {}

    def starts_of(self, file: int, row: int) -> list[np.ndarray]:
        block = row // self.block_rows
        if (file, block) != self.block:
            self.block, self.starts = (file, block), {}
            entries = self.of(file)
            if entries is not None:
                blocks = entries["row"].to_numpy()
                low, high = np.searchsorted(blocks, [block, block + 1])
                for payload in entries["payload"].slice(low, high - low).to_pylist():
                    for r, starts in _unpack_starts(payload).items():
                        self.starts.setdefault(r, []).append(starts)
        return self.starts.get(row, [])


OUT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """Removes each word covered by a window of ``width`` words that also starts in a document with a smaller id.

    Returns the id, ``n_words``, ``n_removed``, ``kept_text`` (the words left, joined by a space) and ``removed``,
    the maximal intervals of removed words. Windows are judged on the input.

    Words are runs without ASCII white space, unchanged. A null text has none; a very long one is a chunk of its own. A
    null id is smaller than all others. Rows with one id are one document with itself: none of them removes a window
    from another. An empty table gives no rows. Windows that agree in 96 bits of hashes count as equal. Columns but
    those two are never read. A table that is not read row by row from Parquet files is stored first.
    """
    docs = in_files(docs)
    file, row = place_of(docs)
    source = docs.select(F.col(id_col).isNotNull().alias("known"), order_id(id_col).alias("id"), text_of(text_col).alias("text"), file.alias("file"), row.alias("row"))
    chars = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(shuffle_partitions(docs.sparkSession), -(-chars // CHARS_IN_RANGE))
    block_rows, chunk_chars = ROWS_IN_BLOCK, CHARS_IN_CHUNK

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, texts, rows, size = None, [], [], [], 0
        for batch in in_slices(batches):
            for id_, text, file, row in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
                block = (file, row // block_rows)
                if ids and (block != here or size + len(text) > chunk_chars):
                    yield _told(list(_send(Chunk(ids, texts, rows, width), *here, ranges)))
                    ids, texts, rows, size = [], [], [], 0
                here, size = block, size + len(text)
                ids.append(id_)
                texts.append(text)
                rows.append(row)
        if ids:
            yield _told(list(_send(Chunk(ids, texts, rows, width), *here, ranges)))

    starts = source.mapInArrow(send, SENT).groupBy("range").applyInArrow(_join_range, "file long, row long, payload binary")
    path = shelve(starts, "window-starts", texts=True)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = _Gone(path, block_rows)
        for batch in in_slices(batches):
            out = []
            for known, id_, text, file, row in zip(*(c.to_pylist() for c in batch.columns)):
                out.append((id_ if known else None, *_clean(text, gone.starts_of(file, row), width)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(OUT_TYPES)], names=[id_col, "n_words", "n_removed", "kept_text", "removed"])

    return source.mapInArrow(clean, f"`{id_col}` long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>")
