"""Packing token pieces into windows of fixed capacity by minimum bin slack.

A document's ids, with an end id, are cut at every multiple of the capacity; whole windows stand alone and the rest,
shorter than a window, waits in a pool. A window is filled from the pool so: the longest waiting piece goes in, then
a subset-sum dynamic program over the multiset of waiting lengths finds the largest total that still fits. The
reachable totals are the bits of an integer; a length that waits c times is shifted in as 1, 2, 4, ... copies, and
walking the steps back gives how many pieces of each length to take. Where even the best total leaves a gap, the
start of another piece is cut off for it.

Every task packs the rows of its own input split in order, so there is no shuffle, memory is bounded by the pool, and
a lost task is repeated with the same result. A split leaves at most one partly filled window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import free_name, in_slices
from .tokens import ID_BYTES, encoder

#: Sequence numbers of a split start at its number times this.
SPLIT_SPAN = 1 << 40

PIECE_FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, with the largest total up to ``room``: {length: copies}."""
    bits, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, chunk = min(counts[length], room // length), 1
        while left:
            chunk = min(chunk, left)
            steps.append((length, chunk, bits))
            bits |= (bits << (length * chunk)) & mask
            left -= chunk
            chunk *= 2
        if bits >> room & 1:
            break
    total, taken = bits.bit_length() - 1, {}
    for length, chunk, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + chunk
            total -= length * chunk
    return taken


@dataclass(slots=True)
class Piece:
    """Ids of a document from ``start`` on: as bytes, with the document's row and number of ids."""

    row: tuple
    start: int
    ids: bytes
    total: int

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first n ids and the others."""
        return replace(self, ids=self.ids[: n * ID_BYTES]), replace(self, start=self.start + n, ids=self.ids[n * ID_BYTES :])


class Pool:
    """Waiting pieces by length."""

    def __init__(self, capacity: int, high: int, low: int) -> None:
        self.capacity, self.high, self.low = capacity, high, low
        self.waiting: dict[int, list[Piece]] = {}
        self.size = 0

    def put(self, piece: Piece) -> None:
        self.waiting.setdefault(len(piece), []).append(piece)
        self.size += 1

    def _take(self, length: int) -> Piece:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[length]
        self.size -= 1
        return piece

    def window(self) -> list[Piece]:
        """The longest piece and the best filling; a gap that is left takes the start of the shortest other piece.

        All pieces that are left are longer than the gap, or one would have fitted.
        """
        longest = max(self.waiting)
        chosen, room = [self._take(longest)], self.capacity - longest
        for length, copies in best_fill({k: len(v) for k, v in self.waiting.items()}, room).items():
            chosen += [self._take(length) for _ in range(copies)]
            room -= length * copies
        if room and self.waiting:
            first, rest = self._take(min(self.waiting)).cut(room)
            chosen.append(first)
            self.put(rest)
        return chosen

    def windows(self, finish: bool = False) -> Iterator[list[Piece]]:
        if finish or self.size >= self.high:
            while self.size > (0 if finish else self.low):
                yield self.window()


def pack_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", capacity: int = 1024, end_id: int = 0, carry: list[str] | None = None, pool_high: int = 4096, pool_low: int = 1024) -> DataFrame:
    """One row for each piece: the carried columns and ``start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Ids are those of the whole text and ``end_id``; ``start`` counts the document's ids before the piece, ``offset``
    the ids before it in its sequence, which has no gaps. ``ids_crc32`` is over unsigned little-endian 32-bit ids.

    A null or empty text is its end id alone. Repeated rows are packed one by one. A carried column (default: all but
    the text) with the name of a result is left out. No rows give no pieces.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in PIECE_FIELDS and (carry is not None or c != text_col)]
    source = docs.select(*[docs[c] for c in names], docs[text_col].cast("string").alias(free_name(docs, "_text")))
    schema = T.StructType([source.schema[c] for c in names] + [T.StructField(f, T.LongType(), False) for f in PIECE_FIELDS])
    end = end_id.to_bytes(ID_BYTES, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        pool, sequence, types = Pool(capacity, pool_high, pool_low), TaskContext.get().partitionId() * SPLIT_SPAN, None
        out: list[tuple] = []

        def place(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                out.append((*p.row, p.start, len(p), zlib.crc32(p.ids), p.total, sequence, offset))
                offset += len(p)
            sequence += 1

        for batch in in_slices(batches):
            types = [f.type for f in batch.schema][:-1]
            carried = [c.to_pylist() for c in batch.columns[:-1]]
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for i, found in enumerate(map(encode.encode, texts)):
                data = found + end
                total, row = len(data) // ID_BYTES, tuple(c[i] for c in carried)
                for start in range(0, total, capacity):
                    piece = Piece(row, start, data[start * ID_BYTES : (start + capacity) * ID_BYTES], total)
                    if len(piece) == capacity:
                        place([piece])
                    else:
                        pool.put(piece)
            for pieces in pool.windows():
                place(pieces)
            if len(out) > 20_000:
                yield _rows(out, names, types)
                out.clear()
        for pieces in pool.windows(finish=True):
            place(pieces)
        encode.rest()
        if out:
            yield _rows(out, names, types)

    return source.mapInArrow(pack, schema)


def _rows(out: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*out))
    arrays = [pa.array(c, t) for c, t in zip(columns, [*types, *[pa.int64()] * len(PIECE_FIELDS)])]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *PIECE_FIELDS])
