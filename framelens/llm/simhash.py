"""SimHash near-dedup with BK-trees.

Fingerprints are computed in one pass over the texts; equal ones collapse to a node before anything else, so a group
of exact copies costs one node. Two 64-bit fingerprints within r bits agree on at least two of r + 2 blocks of bits.
Every pair of blocks is therefore a shard key: a node goes to one shard for each pair, and all its partners meet it in
one of them. A shard holds a BK-tree, whose children are keyed by their distance to the parent; a search follows only
the edges within the radius. A shard above ``shard_limit`` nodes is dealt out anew by pairs of the halves of its
remaining blocks, which leaves 2**16 possible nodes in a shard, so its size is bounded whatever the corpus holds.

A tree of all fingerprints would grow with the corpus and could not be broadcast; here trees stay where their shard
is, and the queries come to them by the shuffle.

A shard returns one link for each node that has a partner in it, to the smallest node it reaches there. The links of
all shards have the same connected components as all pairs within the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, in_slices, stored, text_of
from .components import connected_components

SEED = 42
BITS = 64
#: Bytes of lower-cased text whose shingles are summed at once.
STEP_SHINGLES = 200_000


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text: words split at ASCII white space, A-Z lower-cased, shingles with repeats."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP_SHINGLES):
        here = slice(at, min(at + STEP_SHINGLES, n))
        last = slice(at + shingle - 1, here.stop + shingle - 1)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[here].tolist(), ends[last].tolist())], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def simhash(docs: DataFrame, text_col: str = "text", into: str = "fp", shingle: int = 3, carry: list[str] | None = None) -> DataFrame:
    """Adds the fingerprint of each row's whole text as a signed long.

    A null or empty text, or one of white space only, has fingerprint zero. ``carry`` names the columns to return
    (default: all); a column called ``into`` is replaced.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c != into]
    source = docs.select(*[docs[c] for c in names], docs[text_col].cast("string").alias(free_name(docs, "_text")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column(batch.num_columns - 1)
            found = pa.array([_signed(fingerprint(t or "", shingle)) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*names, into])

    kept = source.select(*names).withColumn(into, F.lit(0).cast("long"))
    return source.mapInArrow(encode, kept.schema)


class BKTree:
    """Integers under Hamming distance. A child's key is its distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, own = 0, len(self.values)
        if own:
            while True:
                distance = (self.values[at] ^ value).bit_count()
                if not distance:
                    return
                below = self.children[at].setdefault(distance, own)
                if below == own:
                    break
                at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """All values at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(self.values[at])
            edges = self.children[at]
            if edges:
                for d in range(max(1, distance - radius), distance + radius + 1):
                    if d in edges:
                        todo.append(edges[d])
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, the smallest value it reaches in the shard) for all but those smallest."""
    tree, parent = BKTree(), {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for value in values:
        if value in parent:
            continue
        parent[value] = value
        for other in tree.within(value, radius):
            low, high = sorted((find(other), find(value)))
            parent[high] = low
        tree.add(value)
    return [(v, root) for v in parent if (root := find(v)) != v]


def _masks(blocks: list[int]) -> list[int]:
    """Signed masks that cover two of the given bit blocks."""
    return [_signed(a | b) for a, b in combinations(blocks, 2)]


def _cut(mask: int, parts: int) -> list[int]:
    """Splits the set bits of a mask into consecutive blocks."""
    bits = [i for i in range(BITS) if mask >> i & 1]
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(edges, edges[1:])]


def near_links(nodes: DataFrame, radius: int = 2, shard_limit: int = 1024) -> DataFrame:
    """Distinct fingerprints ``fp`` to links ``(a, b)`` with the components of all pairs within ``radius`` bits."""
    full = (1 << BITS) - 1
    first = _masks(_cut(full, radius + 2))
    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("shard"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(first)])).alias("s")).select("fp", "s.*")
    sizes = keyed.groupBy("shard", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, ["shard", "key"])
    second = []
    for i, m in enumerate(first):
        rest = _cut(full & ~(m & full), radius + 2)
        second.append(F.array(*[F.struct(F.lit((i + 1) * 1000 + j).alias("shard"), F.col("fp").bitwiseAND(F.lit(_signed((m | x) & full))).alias("key")) for j, x in enumerate(_masks(rest))]))
    small = F.array(F.struct(F.col("shard"), F.col("key")))
    anew = F.element_at(F.array(*second), F.col("shard") + 1)
    dealt = met.select("fp", F.explode(F.when(F.col("n") <= shard_limit, small).otherwise(anew)).alias("s")).select("fp", "s.*")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(values: list[int]) -> list[tuple[int, int]]:
            return shard_links([v % (1 << BITS) for v in values], radius) if len(values) > 1 else []

        here, values, links = None, [], []
        for batch in batches:
            for fp, *key in zip(*(c.to_pylist() for c in batch.columns)):
                if key != here:
                    links += flush(values)
                    here, values = key, []
                values.append(fp)
            if len(links) > 10_000:
                yield _link_batch(links)
                links = []
        yield _link_batch(links + flush(values))

    together = dealt.select("fp", "shard", "key").repartition("shard", "key").sortWithinPartitions("shard", "key", "fp")
    return together.mapInArrow(search, "a long, b long").distinct()


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_signed(x[i]) for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, shard_limit: int) -> DataFrame:
    """Each row's id, a hash of its text, fingerprint, the smallest fingerprint of its component and the smallest id."""
    keyed = docs.select(F.col(id_col), F.xxhash64(text_of(text_col)).alias("text_hash"), F.col(text_col))
    prints = stored(simhash(keyed, text_col, "fp", shingle, [id_col, "text_hash"]), "simhash", texts=True)
    nodes = prints.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = connected_components(near_links(nodes.select("fp"), radius, shard_limit))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return prints.join(of, F.col("fp") == F.col("_fp")).drop("_fp")


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, shard_limit: int = 1024) -> DataFrame:
    """One row for each input row: ``(id, fp, component_id)``.

    Rows are linked where their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest id
    that can be reached, null where no id of the component is known. All texts without words share fingerprint zero
    and so are linked. Repeated rows are one node and each keeps its own output row; an empty table gives no rows.
    """
    return _components(docs, id_col, text_col, shingle, radius, shard_limit).select(id_col, "fp", "component_id")
