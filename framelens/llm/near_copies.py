"""Near copies at a Jaccard similarity of word shingles, found with bands of min-wise hashes and SimHash.

SimHash fingerprints of the distinct shingles come first: the BK-trees of :func:`~framelens.llm.simhash.near_links`, in
shards keyed by shared bit blocks, link those within ``TREE_RADIUS`` bits. At a similarity of 0.8 fingerprints differ in
about ten of 64 bits, too many for such shards, so the trees' groups are completed in shards that are keyed by bands of
min-wise hashes of the shingles: two texts at 0.8 miss each other in all 24 bands of four once in 300,000 times. In these a
text meets all others that the trees haven't put into its group, those of the closest fingerprints first. A link of either
kind counts if the signatures of 512 min-wise hashes agree in the required share, less ``SLACK``. These links only nominate
groups: in each of them, links are then made anew between texts whose whole sets of shingles are similar enough.
Below ``radius`` = 64 fingerprints would also limit the search in bands (a shard then uses a tree where it is small), which
loses some pairs.

Equal texts are one node before anything else. A shard returns a star of links for each of its groups, never pairs, and
compares a node only with groups it isn't in yet, so a large group of near copies costs little more than its size.
A shard above ``shard_limit`` nodes is first cut by a hash of node and band; each band cuts it differently, so a dense group
is connected through the others. Where the nodes of such a shard are not all in one group after that, its parts are
dealt out again part against part, so that all its nodes meet; that makes n / (shard_limit / 2) rows of a node.

Texts are never shuffled but those of nominated nodes, once: they are picked by their places in the files, and the rows
to drop are left out by theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_slices, stored, text_of
from .components import _dealt_anew, connected_components
from .places import Shelf, in_files, place_of, shelve, without
from .simhash import BITS, SEED, BKTree, _signed, near_links

SIGNATURE, BANDS, ROWS = 512, 24, 4
#: By which the limit is lowered where an estimate nominates: four and a half standard errors at 0.8.
SLACK = 0.08
#: Nodes and characters of a nominated group that one task verifies at once.
VERIFY_NODES, VERIFY_CHARS = 512, 1 << 24
STEP = 4096
#: Bits within which the trees link fingerprints: those of :func:`~framelens.llm.simhash.near_duplicate_components`.
TREE_RADIUS = 2
_random = np.random.default_rng(20240229)
_FACTOR = (_random.integers(0, 1 << 31, SIGNATURE, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFT = _random.integers(0, 1 << 32, SIGNATURE, dtype=np.uint32)
#: Shards up to this size use a tree, where the radius is a limit.
TREE_NODES = 256
LINKS = "a long, b long"


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """The 64-bit hashes of the shingles, with repeats; fewer words than a shingle are one."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    return np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)


def sketch(text: str, shingle: int) -> tuple[int, bytes | None, list[int]]:
    """SimHash, signature and band keys of a text; no signature and no keys for one without words."""
    hashes = np.unique(shingle_hashes(text, shingle))
    if not len(hashes):
        return 0, None, []
    ones = np.zeros(BITS, np.int64)
    least = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), STEP):
        part = hashes[at : at + STEP]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        folded = (part ^ (part >> np.uint64(32))).astype(np.uint32)
        least = np.minimum(least, (folded[:, None] * _FACTOR + _SHIFT).min(axis=0))
    fp = int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")
    keys = [_signed(xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), b)) for b in range(BANDS)]
    return _signed(fp), least.astype(np.uint8).tobytes(), keys


def shard_groups(nodes: list[int], prints: np.ndarray, signatures: np.ndarray, radius: int, similarity: float, known: list[int] | None = None) -> list[tuple[int, int]]:
    """(node, smallest node of its group) for all but those smallest; ``nodes`` rise. Nodes that share a value of
    ``known`` are of one group from the first."""
    n = len(nodes)
    group = np.arange(n)
    if known is not None:
        first: dict[int, int] = {}
        group = np.array([first.setdefault(k, i) for i, k in enumerate(known)], np.int64)
    tree, places = (BKTree(), {}) if n <= TREE_NODES and radius < BITS else (None, {})
    for i in range(n):
        if tree is not None:
            value = int(prints[i])
            met = np.array([j for v in tree.within(value, radius) for j in places[v]], np.int64)
            tree.add(value)
            places.setdefault(value, []).append(i)
        else:
            met = np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= radius)
        met = met[np.argsort(np.bitwise_count(prints[met] ^ prints[i]), kind="stable")] if len(met) else met
        while len(met := met[group[met] != group[i]]):
            for at in range(0, len(met), 64):
                block = met[at : at + 64]
                close = block[(signatures[block] == signatures[i]).mean(axis=1) >= similarity]
                if len(close):
                    break
            if not len(close):
                break
            low, high = sorted((group[close[0]], group[i]))
            group[group == high] = low
            met = met[at:]
    return [(nodes[i], nodes[group[i]]) for i in range(n) if group[i] != i]


def exact_groups(nodes: list[int], signatures: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Like :func:`shard_groups`, by the exact similarity of sets; an estimate below it by more than ``SLACK`` rules a pair out."""
    n = len(nodes)
    group = np.arange(n)
    for i in range(1, n):
        share = (signatures[:i] == signatures[i]).mean(axis=1)
        met = np.flatnonzero(share >= similarity - SLACK)
        met = met[np.argsort(-share[met], kind="stable")]
        while len(met := met[group[met] != group[i]]):
            a, b = sets[i], sets[met[0]]
            both = len(np.intersect1d(a, b, assume_unique=True))
            if both / (len(a) + len(b) - both) >= similarity:
                low, high = sorted((group[met[0]], group[i]))
                group[: i + 1][group[: i + 1] == high] = low
            met = met[1:]
    return [(nodes[i], nodes[group[i]]) for i in range(n) if group[i] != i]


def _in_runs(batches: Iterator[pa.RecordBatch], close: Callable[[list[tuple]], list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    """Links of each run of rows that agree in their first two columns; ``close`` takes the others."""
    here, group, links = None, [], []
    for batch in in_slices(batches):
        for key, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, part) != here:
                links += close(group) if len(group) > 1 else []
                here, group = (key, part), []
            group.append(row)
        yield _links(links)
        links = []
    yield _links(links + (close(group) if len(group) > 1 else []))


def _signatures(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, SIGNATURE)


def _verified(nominated: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """Links between the nodes of each nominated group (node, root) with the components of all its exact pairs.

    A large group is first cut twice at random, which connects a dense one; where its nodes are not all one group then,
    its parts are dealt out part against part.
    """
    members = nominated.union(nominated.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("text_hash"), F.col("root").alias("key"))
    members = members.join(nodes.select("text_hash", "sig", "n_chars", "file", "row"), "text_hash")
    count = lambda n, most: F.when(n > most, F.ceil(n / (most // 2))).otherwise(1)
    sizes = members.groupBy("key").agg(F.greatest(count(F.count("*"), VERIFY_NODES), count(F.sum("n_chars"), VERIFY_CHARS)).cast("long").alias("parts"))
    sized = stored(members.drop("n_chars").join(sizes.select(_dealt_anew("key"), "parts"), "key"), "nominated")
    own = lambda cut: F.pmod(F.xxhash64("text_hash", "key", cut), F.col("parts"))
    file, row = place_of(docs)
    texts = docs.select(text_of(text_col).alias("text"), file.alias("file"), row.alias("row"))
    entry = "key long, parts long, text_hash long, sig binary"

    def linked(wanted: DataFrame, parts: Column) -> DataFrame:
        """Links in the parts into which the wanted nodes are dealt, with their texts from the files."""
        path = shelve(wanted.select("file", "row", "key", "parts", "text_hash", "sig"), "nominated-places")

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shelf = Shelf(path)
            for batch in batches:
                for at, entries in shelf.met(batch.column(1).to_numpy(), batch.column(2).to_numpy()):
                    columns = [entries[c].combine_chunks() for c in ("key", "parts", "text_hash", "sig")]
                    yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(pa.array(at))], names=["key", "parts", "text_hash", "sig", "text"])

        def close(group: list[tuple]) -> list[tuple[int, int]]:
            return exact_groups([g[0] for g in group], _signatures([g[1] for g in group]), [np.unique(shingle_hashes(g[2], shingle)) for g in group], similarity)

        dealt = texts.mapInArrow(pick, f"{entry}, text string").select("key", F.explode(parts).alias("part"), "text_hash", "sig", "text")
        return dealt.repartition("key", "part").sortWithinPartitions("key", "part", "text_hash").mapInArrow(lambda batches: _in_runs(batches, close), LINKS).distinct()

    two = F.transform(F.array(F.lit(0), F.lit(1)), lambda cut: cut * F.col("parts") + own(cut))
    links = stored(linked(sized, F.when(F.col("parts") > 1, two).otherwise(F.array(F.lit(0).cast("long")))), "verified", texts=True)
    large = sized.where("parts > 1")
    if large.isEmpty():
        return links
    rooted = _rooted(large, connected_components(links))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(_dealt_anew("key"))
    return links.union(linked(rooted.join(mixed, "key"), _blocks(own(F.lit(0)), F.col("parts")))).distinct()


def tree_links(nodes: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints BK-trees find within ``TREE_RADIUS`` bits, over several if need be.

    ``nodes`` has text_hash, fp and sig. Each is linked to the smallest of its group, if their signatures agree enough:
    fingerprints may be close by chance, and chains of such would make groups of texts that share nothing.
    """
    worded = nodes.where("sig IS NOT NULL").select("text_hash", "fp")
    roots = connected_components(near_links(worded.select("fp").distinct(), TREE_RADIUS))
    placed = worded.join(roots, F.col("fp") == F.col("node"), "left").select("text_hash", F.coalesce("root", "fp").alias("print"))
    least = placed.groupBy("print").agg(F.min("text_hash").alias("a"), F.count("*").alias("n")).where("n > 1")
    pairs = placed.join(least.select(_dealt_anew("print"), "a"), "print").where("text_hash <> a").select("a", F.col("text_hash").alias("b"))
    signed = lambda side: nodes.select(F.col("text_hash").alias(side), F.col("sig").alias(f"sig_{side}"))
    both = pairs.join(signed("b"), "b").join(signed("a"), "a").select("a", "b", "sig_a", "sig_b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            share = (_signatures(batch.column(2).to_pylist()) == _signatures(batch.column(3).to_pylist())).mean(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(share >= similarity))

    return both.mapInArrow(agree, LINKS)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, radius: int, shard_limit: int) -> DataFrame:
    """id, text_hash, place and root of each row of a table in files."""
    file, row = place_of(docs)
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"), file.alias("file"), row.alias("row"), F.length(text_of(text_col)).alias("n_chars"), text_of(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [sketch(t, shingle) for t in batch.column(5).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *columns], names=[*batch.schema.names[:5], "fp", "sig", "bands"])

    schema = keyed.drop("text").withColumns({"fp": F.lit(None).cast("long"), "sig": F.lit(None).cast("binary"), "bands": F.lit(None).cast("array<long>")}).schema
    rows = stored(keyed.mapInArrow(encode, schema), "sketches", texts=True)
    # Copies of a text combine before the shuffle; any of them stands for it.
    node = F.first(F.struct("n_chars", "file", "row", "fp", "sig", "bands")).alias("x")
    nodes = stored(rows.groupBy("text_hash").agg(node).select("text_hash", "x.*"), "nodes")
    trees = stored(tree_links(nodes, similarity - SLACK), "tree-links")
    known = connected_components(trees)
    banded = nodes.select("text_hash", F.explode("bands").alias("key"))
    sizes = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.when(F.col("n") > shard_limit, F.ceil(F.col("n") / max(1, shard_limit // 2))).otherwise(1).cast("long")
    own = F.pmod(F.xxhash64("text_hash", "key"), F.col("parts"))
    met = stored(banded.join(sizes.select(_dealt_anew("key"), "n"), "key").select("text_hash", "key", parts.alias("parts")).withColumn("part", own), "bands")

    def close(group: list[tuple]) -> list[tuple[int, int]]:
        prints = np.array([g[1] for g in group], np.int64).view(np.uint64)
        return shard_groups([g[0] for g in group], prints, _signatures([g[2] for g in group]), radius, similarity - SLACK, [g[3] for g in group])

    def linked(placed: DataFrame) -> DataFrame:
        grouped = _rooted(placed.select("text_hash", "key", "part"), known)
        dealt = grouped.join(nodes.select("text_hash", "fp", "sig"), "text_hash").select("key", "part", "text_hash", "fp", "sig", "root")
        return dealt.repartition("key", "part").sortWithinPartitions("key", "part", "text_hash").mapInArrow(lambda batches: _in_runs(batches, close), LINKS).distinct()

    links = stored(linked(met).union(trees).distinct(), "links")
    large = met.where("parts > 1")
    if not large.isEmpty():
        rooted = _rooted(large, connected_components(links))
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(_dealt_anew("key"))
        anew = rooted.join(mixed, "key").withColumn("part", F.explode(_blocks(F.col("part"), F.col("parts"))))
        links = links.union(linked(anew)).distinct()
    roots = connected_components(_verified(connected_components(links), nodes, docs, text_col, shingle, similarity))
    return _rooted(rows.select("id", "text_hash", "file", "row"), roots)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = BITS, shard_limit: int = 8192) -> DataFrame:
    """One row for each input row: id, ``text_hash`` and ``root``, which rows of a group share.

    Rows are linked where their sets of ``shingle`` words (A-Z lower-cased) have a Jaccard similarity of at least
    ``similarity``. A null text is empty; texts without words are linked to their equals only, and a very long text is
    read whole. Repeated rows are one node and keep their rows; an empty table gives no rows. Columns but those two are
    never read. A table that is not read row by row from Parquet files is stored first.
    """
    found = _grouped(in_files(docs), id_col, text_col, shingle, similarity, radius, shard_limit)
    return found.select(F.col("id").alias(id_col), "text_hash", "root")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds the smallest node of the group of each ``text_hash``."""
    return rows.join(roots.withColumnRenamed("root", "_root"), F.col("text_hash") == F.col("node"), "left").withColumn("root", F.coalesce("_root", "text_hash")).drop("node", "_root")


def _blocks(part: Column, parts: Column) -> Column:
    """The blocks in which a part meets every other one, and so itself; the only part has one block."""
    others = F.filter(F.sequence(F.lit(0).cast("long"), parts - 1), lambda q: q != part)
    return F.when(parts > 1, F.transform(others, lambda q: F.least(part, q) * parts + F.greatest(part, q))).otherwise(F.array(F.lit(0).cast("long")))


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, shard_limit: int = 8192) -> DataFrame:
    """The rows of ``docs`` less all but one of each group: the one with the smallest id, a null before others.

    Of rows with this id the one whose text has the smallest hash stays, and of rows with this text too any one. All
    columns are kept as they are, whatever they are called; groups are those of :func:`near_copies`, which says what
    null, empty and long texts and empty tables give.
    """
    docs = in_files(docs)
    found = stored(_grouped(docs, id_col, text_col, shingle, similarity, BITS, shard_limit), "groups")
    first = found.groupBy("root").agg(F.min(F.struct("id", "text_hash", "file", "row")).alias("k"))
    stays = first.select(_dealt_anew("root"), F.col("k.file").alias("_file"), F.col("k.row").alias("_row"))
    gone = found.join(stays, "root").where((F.col("file") != F.col("_file")) | (F.col("row") != F.col("_row")))
    return without(docs, shelve(gone.select("file", "row"), "dropped"))
