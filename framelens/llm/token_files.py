"""Token-id files with keyed access through a minimal perfect hash.

A shard is two files in the shared store. ``.ids`` holds an eight-byte head and then nothing but the ids of its
documents, in order, as unsigned little-endian integers of the smallest width that fits the vocabulary. ``.idx`` holds
a minimal perfect hash over the keys and the keys in order: a key (id, occurrence) is mapped to a slot by testing one
bit in each of a few levels and counting the bits before it, and the slot stores a fingerprint of its key, the offset
and the number of ids. A key that is not there is told by its fingerprint, but for one in 2**32. All parts of ``.idx``
have fixed widths, so a lookup reads its head, a block of bits for each level it tests, a count and a slot, whatever
the number of documents; only a reader of all documents reads it whole.

Texts are dealt out by ranges of ids and each task encodes and writes one range as it streams by, so memory holds the
keys of a shard but never its ids. Rows that repeat an id may fill many shards: a shard numbers its own, and the
manifest tells how many rows with its first id stand in the shards before. File names carry the attempt; the stored
manifest lists those of the attempt that Spark committed, so a lost or repeated task leaves at most files that nothing
refers to.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, in_slices, order_id, scratch_path, shuffle_partitions, stored, text_of
from .tokens import ID_BYTES, encoder

MAGIC, INDEX_MAGIC = b"FLIDS1", b"FLIDX2"
HEAD = 8
MAX_LEVELS = 64
GAMMA = 1.5
READ_BLOCK = 4 << 20
#: Head of an index: magic, then n, seed, number of levels and the bits of each level.
INDEX_HEAD = HEAD + 8 * (3 + MAX_LEVELS)
#: Words of bits between two stored counts.
RANK_WORDS = 8
SLOT = np.dtype([("print", "<u4"), ("count", "<u4"), ("offset", "<i8")])
KEY = np.dtype([("id", "<i8"), ("occurrence", "<i8"), ("known", "u1")])

MANIFEST = "shard int, first_known boolean, first_id long, head long, last_known boolean, last_id long, tail long, n_docs long, n_ids long, payload string, index string"


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser, keyed by a seed."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(ids: np.ndarray, known: np.ndarray, occurrence: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 bits for each key: a document id, whether it is known, and its number among the rows with this id."""
    row = np.asarray(occurrence, np.uint64) * np.uint64(2) + np.asarray(known, np.uint64)
    return _mix(np.asarray(ids, np.int64).view(np.uint64) ^ _mix(row, 100 + seed), 8)


def key_prints(values: np.ndarray) -> np.ndarray:
    return (_mix(values, 99) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit values: n values to the slots 0 to n - 1."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray) -> None:
        self.bits, self.sizes = bits, sizes
        self.starts = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(bits))].astype(np.int64)

    @classmethod
    def build(cls, values: np.ndarray) -> PerfectHash:
        """Values that are alone on their bit of a level stay there, the others go on to the next."""
        levels, sizes, left = [], [], values
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("the values are not distinct")
            size = -(-int(GAMMA * len(left) + 1) // 64) * 64
            place = (_mix(left, 16 + len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[place]]
        return cls(np.concatenate(levels) if levels else np.zeros(0, np.uint64), np.array(sizes, np.int64))

    def slots(self, values: np.ndarray) -> np.ndarray:
        """The slot of each value; -1 where none of the levels knows it."""
        out = np.full(len(values), -1, np.int64)
        todo = np.arange(len(values))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes)):
            place = start + (_mix(values[todo], 16 + level) % np.uint64(size)).astype(np.int64)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            there = (self.bits[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[there]] = (self.before[word] + below)[there]
            todo = todo[~there]
        return out


def build_index(ids: np.ndarray, known: np.ndarray, occurrence: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> bytes:
    """The bytes of an index over distinct keys; the seed is the first that gives them distinct hashes."""
    seed = 0
    while len(np.unique(values := key_hash(ids, known, occurrence, seed))) < len(values):
        seed += 1
    hashed = PerfectHash.build(values)
    slots = np.zeros(len(ids), SLOT)
    at = hashed.slots(values)
    slots["print"][at], slots["offset"][at], slots["count"][at] = key_prints(values), offsets, counts
    keys = np.zeros(len(ids), KEY)
    keys["id"], keys["known"], keys["occurrence"] = ids, known, occurrence
    head = np.array([len(ids), seed, len(hashed.sizes), *hashed.sizes], "<u8").tobytes()
    ranks = hashed.before[:-1:RANK_WORDS].astype("<u8")
    return b"".join([INDEX_MAGIC.ljust(HEAD, b"\0"), head.ljust(INDEX_HEAD - HEAD, b"\0"), hashed.bits.astype("<u8").tobytes(), ranks.tobytes(), slots.tobytes(), keys.tobytes()])


class ShardIndex:
    """An index file: lookups of single keys by bounded reads, or all keys at once."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        head = file.read_at(INDEX_HEAD, 0)
        if head[: len(INDEX_MAGIC)] != INDEX_MAGIC:
            raise ValueError("not an index of a token file")
        self.n, self.seed, levels, *sizes = (int(x) for x in np.frombuffer(head[HEAD:], "<u8"))
        self.sizes = np.array(sizes[:levels], np.int64)
        self.words = int(self.sizes.sum()) // 64
        self.ranks_at = INDEX_HEAD + 8 * self.words
        self.slots_at = self.ranks_at + 8 * -(-self.words // RANK_WORDS)
        self.keys_at = self.slots_at + SLOT.itemsize * self.n

    def find(self, doc_id: int, known: bool, occurrence: int) -> tuple[int, int] | None:
        """Offset and number of ids of one key, from a few small reads; null for a key that is not there."""
        value = key_hash(np.array([doc_id], np.int64), np.array([known]), np.array([occurrence]), self.seed)
        start = 0
        for level, size in enumerate(self.sizes.tolist()):
            place = start + int(_mix(value, 16 + level)[0] % np.uint64(size))
            block, inside = divmod(place, 64 * RANK_WORDS)
            bits = int.from_bytes(self.file.read_at(8 * min(RANK_WORDS, self.words - block * RANK_WORDS), INDEX_HEAD + 8 * RANK_WORDS * block), "little")
            if bits >> inside & 1:
                before = int.from_bytes(self.file.read_at(8, self.ranks_at + 8 * block), "little")
                slot = before + (bits & ((1 << inside) - 1)).bit_count()
                found = np.frombuffer(self.file.read_at(SLOT.itemsize, self.slots_at + SLOT.itemsize * slot), SLOT)[0]
                return (int(found["offset"]), int(found["count"])) if found["print"] == key_prints(value)[0] else None
            start += size
        return None

    def everything(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All keys in order, and the offset and number of ids that the index gives for each; -1 where it has none."""
        bits = np.frombuffer(self.file.read_at(8 * self.words, INDEX_HEAD), "<u8")
        slots = np.frombuffer(self.file.read_at(SLOT.itemsize * self.n, self.slots_at), SLOT)
        keys = np.frombuffer(self.file.read_at(KEY.itemsize * self.n, self.keys_at), KEY)
        values = key_hash(keys["id"], keys["known"], keys["occurrence"], self.seed)
        at = PerfectHash(bits, self.sizes).slots(values)
        there = at >= 0
        there[there] = slots["print"][at[there]] == key_prints(values[there])
        return keys, np.where(there, slots["offset"][at], -1), np.where(there, slots["count"][at], 0).astype(np.int64)


def _open(uri: str) -> pa.NativeFile:
    store, path = arrow_fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


class TokenShard:
    """Reads a shard: any document in constant time, or all in order."""

    def __init__(self, payload: str, index: str) -> None:
        self.file, self._index_file = _open(payload), _open(index)
        self.index = ShardIndex(self._index_file)
        head = self.file.read_at(HEAD, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"not a token file: {payload}")
        self.width = int.from_bytes(head[len(MAGIC) : HEAD], "little")
        self._block, self._from = b"", 0

    def ids(self, offset: int, count: int) -> np.ndarray:
        """Just these ids, as unsigned 32-bit integers."""
        return np.frombuffer(self.file.read_at(count * self.width, HEAD + offset * self.width), f"<u{self.width}").astype("<u4")

    def read(self, offset: int, count: int) -> np.ndarray:
        """The ids as unsigned 32-bit integers; neighbouring reads share blocks of the file."""
        start, size = HEAD + offset * self.width, count * self.width
        if not self._from <= start <= start + size <= self._from + len(self._block):
            self._block, self._from = self.file.read_at(max(READ_BLOCK, size), start), start
        data = self._block[start - self._from : start - self._from + size]
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def get(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of the document with this number among the shard's rows with its id."""
        found = self.index.find(NULL_ID if doc_id is None else doc_id, doc_id is not None, occurrence)
        return None if found is None else self.ids(*found)

    def close(self) -> None:
        self.file.close()
        self._index_file.close()


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Encodes every whole text and writes shards in ascending order of ids; returns the manifest, a row for each shard.

    ``folder`` is a URI in a store that the executors share (default: a scratch folder there). A null or empty text is
    the end id alone; a very long one is encoded whole. A null id sorts first and is a key of its own. Rows that repeat
    an id follow each other, over as many shards as they fill, and are told apart by their occurrence. No rows write
    no files. Columns but those two are never read.

    The manifest has the first and last id of each shard with the number of its rows that have it (``head``, ``tail``),
    and in ``first_occurrence`` the number of rows with its first id in the shards before.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    source = docs.select(F.col(id_col).isNotNull().alias("_known"), order_id(id_col).alias("_id"), text_of(text_col).alias("_text"))
    # Rows that agree in id and text are dealt out by where they come from, so that they may fill several shards.
    source = source.withColumns({"_hash": F.xxhash64("_text"), "_from": F.spark_partition_id()})
    order = ["_known", "_id", "_hash", "_from"]
    dealt = source.repartitionByRange(shards or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    end = end_id.to_bytes(ID_BYTES, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = in_slices(batches)
        first = next(batches, None)
        if first is None:
            return
        encode = encoder(tokenizer_path)
        width = 2 if encode.vocabulary <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        store, base = arrow_fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}"
        ids, known, counts = [], [], []
        with store.open_output_stream(f"{base}/{name}.ids") as out:
            out.write(MAGIC + width.to_bytes(HEAD - len(MAGIC), "little"))
            for batch in (b for part in ((first,), batches) for b in part):
                for there, doc, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), map(encode.encode, batch.column(2).to_pylist())):
                    data = found + end
                    out.write(np.frombuffer(data, "<u4").astype(f"<u{width}").tobytes())
                    ids.append(doc)
                    known.append(there)
                    counts.append(len(data) // ID_BYTES)
        encode.rest()
        keys, number = np.array(ids, np.int64), np.array(counts, np.int64)
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | np.diff(np.array(known, np.int8)).astype(bool)]
        place = np.arange(len(keys))
        occurrence = place - np.maximum.accumulate(np.where(fresh, place, 0))
        with store.open_output_stream(f"{base}/{name}.idx") as out:
            out.write(build_index(keys, np.array(known), occurrence, np.cumsum(number) - number, number))
        heads = np.flatnonzero(fresh)
        row = (shard, known[0], ids[0], int(heads[1] if len(heads) > 1 else len(ids)), known[-1], ids[-1], len(ids) - int(heads[-1]), len(ids), int(number.sum()), f"{folder}/{name}.ids", f"{folder}/{name}.idx")
        types = (pa.int32(), *(pa.bool_(), pa.int64(), pa.int64()) * 2, pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[f.split()[0] for f in MANIFEST.split(", ")])

    written = stored(dealt.mapInArrow(write, MANIFEST), "manifest", texts=True)
    # Rows that share an id are neighbours, so a shard before that has some ends in them.
    ends = written.select("shard", F.col("last_known").alias("known"), F.col("last_id").alias("id"), F.lit(1).alias("end"), F.col("tail").alias("rows"))
    starts = written.select("shard", F.col("first_known").alias("known"), F.col("first_id").alias("id"), F.lit(0).alias("end"), F.lit(0).cast("long").alias("rows"))
    before = Window.partitionBy("known", "id").orderBy("shard", "end").rowsBetween(Window.unboundedPreceding, 0)
    earlier = ends.union(starts).withColumn("first_occurrence", F.sum("rows").over(before)).where("end = 0").select("shard", "first_occurrence")
    return written.join(earlier, "shard")


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document of the shards through their indexes: id, ``occurrence``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it, in this shard and in those before; ``occurrence`` the rows
    with this id before it, in all shards. A key that its index doesn't find raises an error. An empty manifest gives
    no rows.
    """
    # A row for each shard: bounded by their number, which the writer was given.
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("payload", "index", "first_occurrence", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, index, earlier, base in zip(*(c.to_pylist() for c in batch.columns)):
                shard = TokenShard(payload, index)
                keys, offsets, counts = shard.index.everything()
                if (offsets < 0).any():
                    raise ValueError(f"a key is missing in {index}")
                crcs = [zlib.crc32(shard.read(o, n).tobytes()) for o, n in zip(offsets.tolist(), counts.tolist())]
                shard.close()
                first = (keys["id"] == keys["id"][0]) & (keys["known"] == keys["known"][0])
                occurrence = keys["occurrence"] + np.where(first, earlier, 0)
                columns = [pa.array(keys["id"].copy(), pa.int64(), mask=keys["known"] == 0), pa.array(occurrence, pa.int64()), pa.array(base + offsets, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "occurrence", "start", "n_tokens", "ids_crc32"])

    spread = based.repartition(shuffle_partitions(manifest.sparkSession))
    return spread.mapInArrow(read, f"`{id_col}` long, occurrence long, start long, n_tokens long, ids_crc32 long")


def open_document(manifest: DataFrame, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
    """The ids of one document; null if there is none with this id (null: an unknown one) and number.

    The manifest tells the only shard that can hold it, its index the place: bounded reads from both files.
    """
    known, key = doc_id is not None, NULL_ID if doc_id is None else doc_id
    at_first = (F.col("first_known") == known) & (F.col("first_id") == key)
    at_last = (F.col("last_known") == known) & (F.col("last_id") == key)
    wanted, low, high = (F.struct(F.lit(known).alias("k"), F.lit(key).alias("i")), *(F.struct(F.col(f"{end}_known").alias("k"), F.col(f"{end}_id").alias("i")) for end in ("first", "last")))
    inside = manifest.where((low <= wanted) & (wanted <= high)).withColumn("number", F.lit(occurrence) - F.when(at_first, F.col("first_occurrence")).otherwise(0))
    fits = (F.col("number") >= 0) & (~at_first | (F.col("number") < F.col("head"))) & (~at_last | (F.col("number") < F.col("tail")))
    row = inside.where(fits).first()
    if row is None:
        return None
    shard = TokenShard(row["payload"], row["index"])
    found = shard.get(doc_id, row["number"])
    shard.close()
    return found
